"""Forms and tagged facts: label and value cells become keyed values; tagged cells become facts; sections of notices.

The cells of one document are read in one call, as rows lean on the rows above them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.scalars import EMPTY_VALUES
from docloom.session import ship
from docloom.sources.markup import CELLS, Node, grid, span, squeeze, tree

NAMES = frozenset(("title", "cover-title"))


def flat_text(node: Node) -> str:
    return " ".join(squeeze(node.text()).split())


def tables_with_path(root: Node) -> Iterator[tuple[Node, list[str]]]:
    """Outer tables in document order, each with the titles that are open at its depth."""

    stack: list[list] = [[root.nodes(), 0, []]]  # what is left of an element, its depth, the titles open in it
    while stack:
        rest, depth, titles = stack[-1]
        x = next(rest, None)
        if x is None:
            stack.pop()
        elif x.tag in NAMES:
            if name := flat_text(x):
                stack[-1][2] = [*titles[:depth], name]
        elif x.tag == "table":
            yield x, titles
        else:
            stack.append([x.nodes(), depth + 1, titles])


def rows_of(table: Node) -> list[list[Node]]:
    rows = ([c for c in tr.nodes() if c.tag in CELLS] for tr in table.find("tr", stop=frozenset(("table",))))
    return [r for r in rows if r]


def facts(root: Node) -> Iterator[dict]:
    """Cells with a code: their place, value, normal form, and the label cells to their left."""
    for t, (table, path) in enumerate(tables_with_path(root)):
        for r, cells in enumerate(rows_of(table)):
            labels: list[str] = []
            for c, cell in enumerate(cells):
                text, code = flat_text(cell), cell.attrs.get("acode") or cell.attrs.get("aunit")
                if cell.tag in ("td", "th"):
                    labels += [text] if text else []
                elif code:
                    yield {"table_idx": t, "row_idx": r, "col_idx": c, "code": code, "tag": cell.tag, "value": text, "norm": cell.attrs.get("aunitvalue"), "labels": list(labels), "table_path": path}


def pair(cells: list[tuple[str, bool]], inherited: list[str] = (), suffix: bool = True) -> list[tuple[list[str], str | None]]:
    """Keys and values of a row of (text, is_label): a run of labels names the run of values behind it.

    Of several values under one name the later are numbered. Values without a label take the labels
    inherited from above. Labels at the end follow the last value as its suffix, as a unit does.
    """
    runs: list[tuple[bool, list[str]]] = []
    for text, is_label in cells:
        if is_label and not text:
            continue
        if runs and runs[-1][0] == is_label:
            if not (is_label and runs[-1][1][-1] == text):
                runs[-1][1].append(text)
        else:
            runs.append((is_label, [text]))
    out: list[tuple[list[str], str | None]] = []
    names: list[str] = list(inherited)
    for k, (is_label, texts) in enumerate(runs):
        if is_label:
            if k == len(runs) - 1 and out and suffix:
                key, value = out[-1]
                out[-1] = (key, f"{value} {' '.join(texts)}" if value is not None else None)
            else:
                names = [*inherited, *texts]
        else:
            for n, v in enumerate(texts, 1):
                if names:
                    out.append(([*names[:-1], names[-1] if n == 1 else f"{names[-1]} [{n}]"], None if v.strip() in EMPTY_VALUES else v))
    return out


def form_values(root: Node, is_value: Callable[[Node], bool] | None = None, drop_empty: bool = True) -> Iterator[dict]:
    """Keyed values of a document's forms. A label that spans rows is passed on to the rows it covers."""
    is_value = is_value or (lambda c: c.tag in ("te", "tu") or "xforms_input" in c.attrs.get("class", "") or any(True for _ in c.find("a")))
    for t, (table, path) in enumerate(tables_with_path(root)):
        rows = rows_of(table)
        places = grid([[(span(c.attrs.get("rowspan")), span(c.attrs.get("colspan"))) for c in r] for r in rows])
        for r, line in enumerate(places):
            own, above, last = [], [], None
            for p in line:
                if p is None or p == last:
                    continue
                last = p
                cell = rows[p[0]][p[1]]
                if p[0] == r:
                    own.append((flat_text(cell), not is_value(cell)))
                elif not is_value(cell) and (text := flat_text(cell)):
                    above.append(text)
            for keys, value in pair(own, above):
                if value is not None or not drop_empty:
                    yield {"table_idx": t, "row_idx": r, "keys": keys, "value": value, "table_path": path}


def colon_pair(cells: list[str]) -> tuple[str, str] | None:
    """`label :` and a value in exactly two cells; a label of thirty characters at most, without its spaces."""
    if len(cells) == 2 and (m := re.fullmatch(r"\s*(.{1,30}?)\s*[:：]\s*", cells[0])):
        return re.sub(r"\s+", "", m[1]), cells[1]
    return None


def value_runs(cells: Column) -> Column:
    """Of an array of structs (text, is_label) how many label runs stand before a value: the row's keyed values."""
    pairs = F.zip_with(F.slice(cells, 1, F.size(cells) - 1), F.slice(cells, 2, F.size(cells) - 1), lambda a, b: (a["is_label"] & ~b["is_label"]).cast("int"))
    return F.when(F.size(cells) > 1, F.aggregate(pairs, F.lit(0), lambda s, x: s + x)).otherwise(0)


_PLACE = [("table_idx", pa.int32()), ("row_idx", pa.int32())]
_FACT = pa.struct([*_PLACE, ("col_idx", pa.int32()), ("code", pa.string()), ("tag", pa.string()), ("value", pa.string()), ("norm", pa.string()), ("labels", pa.list_(pa.string())), ("table_path", pa.list_(pa.string()))])
_VALUE = pa.struct([*_PLACE, ("keys", pa.list_(pa.string())), ("value", pa.string()), ("table_path", pa.list_(pa.string()))])
FACT_DDL = "table_idx:int,row_idx:int,col_idx:int,code:string,tag:string,value:string,norm:string,labels:array<string>,table_path:array<string>"
VALUE_DDL = "table_idx:int,row_idx:int,keys:array<string>,value:string,table_path:array<string>"


def _rows(df: DataFrame, key: str, source: str, what, kind: pa.DataType, ddl: str) -> DataFrame:
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([list(what(tree(x or ""))) for x in part.column(1).to_pylist()], pa.list_(kind))], [key, "found"])

    rows = df.select(key, F.col(source).alias("source")).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, found array<struct<{ddl}>>")
    return rows.select(key, F.explode("found").alias("f")).select(key, "f.*")


def extract_facts(df: DataFrame, key: str, source: str) -> DataFrame:
    """Tagged facts of each document; (table_idx, row_idx, col_idx, code) tells them apart."""
    return _rows(df, key, source, facts, _FACT, FACT_DDL)


def extract_values(df: DataFrame, key: str, source: str) -> DataFrame:
    """Keyed values of each document's forms."""
    return _rows(df, key, source, form_values, _VALUE, VALUE_DDL)


def field_view(values: DataFrame, key: str) -> DataFrame:
    """Values by path, repeated paths numbered."""
    from pyspark.sql import Window

    path = F.array_join("keys", " > ")
    n = F.row_number().over(Window.partitionBy(key, path).orderBy("table_idx", "row_idx"))
    return values.select(key, F.when(n == 1, path).otherwise(F.concat(path, F.lit("#"), n.cast("string"))).alias("field"), "value")
