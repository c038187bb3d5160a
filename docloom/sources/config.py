"""Settings: environment over file over default; policies from YAML; paths and names in NFC."""

from __future__ import annotations

import json
import os
import unicodedata
from functools import cache
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.policy import Rule
from docloom.session import ship


def resolve(key: str, default: str | None = None, variable: str | None = None, path: str | None = None) -> str | None:
    """A setting: the environment variable if it is set, else the JSON file's value, else the default."""
    if variable and os.environ.get(variable):
        return os.environ[variable]
    if path and Path(path).is_file() and (found := json.loads(Path(path).read_text(encoding="utf-8")).get(key)) is not None:
        return found
    return default


@cache
def load_policy(path: str) -> tuple[Rule, ...]:
    """Rules of a YAML file: policies with id, stage, detect {type, pattern}, handle {type, to}, severity; read once for a path."""
    import yaml

    names = {"count_only": "count", "record_only": "record"}
    out = []
    for p in yaml.safe_load(Path(path).read_text(encoding="utf-8"))["policies"]:
        detect, handle = p.get("detect", {}), p.get("handle", {})
        out.append(Rule(p["id"], p["stage"], detect.get("pattern") if detect.get("type") == "regex" else None, names.get(handle.get("type"), handle.get("type", "record")), p.get("severity", "info"), handle.get("to") or ""))
    return tuple(out)


def nfc(df: DataFrame, *columns: str) -> DataFrame:
    """df with the columns in NFC; Spark has no such function."""
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    return df.withColumns({c: F.when(F.col(c).rlike(r"^[\x00-\x7f]*$"), F.col(c)).otherwise(normal(F.col(c))) for c in columns})


def on_disk(path: str) -> str | None:
    """The first of the path's NFC, NFD and own forms that exists, on the driver."""
    return next((p for p in (unicodedata.normalize("NFC", path), unicodedata.normalize("NFD", path), path) if os.path.exists(p)), None)


def relative(path: Column, root: str) -> Column:
    """A path below root, with slashes."""
    return F.regexp_replace(F.regexp_replace(path, r"\\", "/"), f"^(file:)?/*{root.strip('/')}/", "")
