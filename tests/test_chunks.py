"""Chunks against a fold over the blocks, one after another."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docloom.functions import scalars as S
from docloom.operators import chunks, documents

LABEL = re.compile(r"제\s*\d{1,3}\s*기(?:\s*\d{1,2}\s*분기|\s*반기)?(?:\s*(?:기말|기초|말|초))?(?:\s*(?:누적|\d{1,2}\s*개월))?")
CAPTION = re.compile(r"\(\s*단\s*위\s*[:：]\s*([^)]*)\)")
ANYWHERE = re.compile(r"단\s*위\s*[:：]|\(단위|\(원\)|백만원|천원|USD")
BLOCK = "part string, seq int, kind string, level int, text string, keys array<string>, value string, headers array<string>, rows array<array<string>>"


def fold(blocks, meta, shown, confidence, size):
    out, section, lines = [], [], []
    unit = source = None
    labels = []

    def emit(kind, body, extra=None, unit=None, source=None, **more):
        head = " · ".join(x for x in meta if x)
        dates = {x: shown(x) for x in labels if shown(x)}
        top = [f"[{head}]"] if head else []
        top += ["> " + " > ".join(section)] if section else []
        top += [f"(단위: {unit})"] if unit else []
        top += ["(" + " · ".join(f"{k} = {v}" for k, v in dates.items()) + ")"] if dates else []
        top += [extra] if extra else []
        out.append({"kind": kind, "text": "\n".join([*top, body]), "section_path": list(section), "unit": unit, "unit_source": source, "periods": list(labels), "period_dates": dates, "footnotes": None, "unit_known": None, "parse_confidence": None} | more)
        c = out[-1]
        if kind == "table" and c["numeric_ratio"] >= 0.2:
            c["unit_known"] = bool(unit) or bool(ANYWHERE.search(c["text"]))

    def flush():
        if lines:
            emit("text", "\n".join(lines), unit=unit, source=source)
            lines.clear()

    def name(text):
        for m in LABEL.finditer(text or ""):
            x = re.sub(r"\s+", " ", m[0])
            if x not in labels:
                labels.append(x)

    for _, _, kind, level, text, keys, value, headers, rows in blocks:
        if kind == "h":
            flush()
            section[:] = [*section[: max(1, min(level, 6)) - 1], text]
            unit = source = None
            labels.clear()
        elif kind == "kv":
            lines.append(f"- {' > '.join(keys)}: {'(해당없음)' if value is None else value}")
        elif kind == "p":
            if re.match(r"\s*[※*＊]", text) and not lines and out and out[-1]["kind"] == "table":
                c = out[-1]
                c["text"] += "\n" + text
                c["footnotes"] = [*(c["footnotes"] or []), text]
                if not c["unit_known"] and ANYWHERE.search(text):
                    c["unit_known"], c["unit_source"] = True, c["unit_source"] or "footnote"
            elif m := CAPTION.search(text):
                unit, source = m[1].strip(), "preceding_caption"
                if CAPTION.sub("", text).strip():
                    lines.append(text)
            else:
                name(text)
                lines.append(text)
        else:
            flush()
            m = CAPTION.search(" ".join(headers))
            own = (m[1].strip(), "table_header") if m else (unit, source)
            for x in headers:
                name(x)
            sure = next((g for cap, g in confidence if cap and cap in " ".join(section)), None)
            for a in range(0, max(1, len(rows)), size):
                piece, esc = rows[a : a + size], lambda x: (x or "").replace("|", "\\|").replace("\n", " ")
                cells = [x.strip() for r in piece for x in r if (x or "").strip()]
                body = ["| " + " | ".join(map(esc, headers)) + " |", "| " + " | ".join("---" for _ in headers) + " |"]
                body += ["| " + " | ".join(([esc(x) for x in r] + [""] * len(headers))[: len(headers)]) + " |" for r in piece]
                extra = f"(표 {a + 1}–{a + len(piece)}행 / 전체 {len(rows)}행)" if len(rows) > size else None
                emit("table", "\n".join(body), extra, *own, n_rows=len(piece), n_cols=len(headers), numeric_ratio=round(sum(bool(re.match(r"^-?\(?[\d,]{4,}\)?$", x)) for x in cells) / len(cells), 3) if cells else 0.0, parse_confidence=sure)
    flush()
    return out


def random_blocks(rnd, part):
    texts = ["그냥 문단이다", "제 17 기 1분기 3개월 매출액은 늘었다", "제18기 반기 누적", "(단위 : 천원)", "(단 위 : 원) 2023년 기준", "아래 표는 매출을 보인다 (단위 : 원) 2023년 기준", "※ 상기 금액은 백만원", "* 주석", "＊ (단위: USD)", "( 단위 : )", "제 17 기 2023.03.31 현재", ""]
    cell = lambda: rnd.choice(["1,234", "a|b", "12345", "x\ny", "", None, "(9,999)", "가나"])
    rows = []
    for seq in range(rnd.randrange(1, 30)):
        kind = rnd.choice("hppppptkk")
        if kind == "h":
            rows.append((part, seq, "h", rnd.choice([1, 2, 3, 9]), rnd.choice(["재무제표", "주석 일반", "개요"]), None, None, None, None))
        elif kind == "p":
            rows.append((part, seq, "p", None, rnd.choice(texts), None, None, None, None))
        elif kind == "k":
            rows.append((part, seq, "kv", None, None, ["a", f"b{seq}"], rnd.choice([None, "v"]), None, None))
        else:
            headers = [rnd.choice(["과목", "제 17 기", "제 17 기 1분기", "금액 (단위 : 억원)", "비고"]) for _ in range(rnd.randrange(1, 4))]
            rows.append((part, seq, "t", None, None, None, None, headers, [[cell() for _ in range(rnd.randrange(1, 5))] for _ in range(rnd.choice([0, 1, 2, 5, 9]))]))
    return rows


def test_chunks_are_the_fold(spark):
    rnd, size = random.Random(11), 4
    parts = {f"p{i}": random_blocks(rnd, f"p{i}") for i in range(60)}
    meta = {p: rnd.choice([("가나", "보고서", "20240101"), ("가나", None, ""), (None, None, None)]) for p in parts}
    df = spark.createDataFrame([b for rows in parts.values() for b in rows], BLOCK)
    periods = documents.period_dictionary(df.filter("kind = 'p'"), "part", F.col("text"))
    dates = {}
    for r in periods.filter("resolved").orderBy("place").collect():
        dates.setdefault(r.part, []).append((re.sub(r"\s+", "", r.label), r.period.begin))
    sure = [("재무제표", "high"), ("주석", "low")]
    confidence = spark.createDataFrame([(p, i, c, g) for p in parts for i, (c, g) in enumerate(sure)], "part string, place int, caption string, parse_confidence string")
    found = chunks.build_chunks(df, "part", size, spark.createDataFrame([(p, *m) for p, m in meta.items()], "part string, corp_name string, report_nm string, rcept_dt string"), periods, confidence)
    got = {}
    for r in found.orderBy("chunk_id").collect():
        got.setdefault(r.part, []).append(r)
    n = 0
    for p, rows in parts.items():

        def shown(label, p=p):
            own = re.sub(r"\s+", "", label)
            best = [(len(k), -i, v) for i, (k, v) in enumerate(dates.get(p, [])) if own.startswith(k)]
            return max(best)[2] if best else None

        want = fold(rows, meta[p], shown, sure, size)
        assert len(got.get(p, [])) == len(want)
        for i, (g, w) in enumerate(zip(got.get(p, []), want, strict=True)):
            n += 1
            assert g.chunk_id == f"{p}#{i:04d}" and g.n_chars == len(w["text"])
            for k, v in w.items():
                assert g[k] == v, (p, i, k)
    assert n > 300


def test_no_paragraph_is_lost(spark):
    rows = [("x", 0, "p", None, "아래 표는 매출을 보인다 (단위 : 원) 2023년 기준", None, None, None, None), ("x", 1, "t", None, None, None, None, ["과목"], [["1,000"]])]
    got = chunks.build_chunks(spark.createDataFrame(rows, BLOCK), "part").orderBy("chunk_id").collect()
    assert "아래 표는" in got[0].text and got[1].unit == "원" and got[1].unit_known


@pytest.mark.parametrize(
    "column,cases",
    [
        (S.number, {"12d": None, "1f": None, "1e5": None, "NaN": None, "Infinity": None, "1,234.5": 1234.5, "(1 234)": -1234.0, "-7": -7.0, ",": None, "(-5)": 5.0, "": None}),
        (S.caption_unit, {"(단 위 : 원)": "원", "(단위:천원) x": "천원", "단위 : 원": None, "(단위 : )": ""}),
        (S.caption_kind, {"(단 위 : 원)": "unit", " ※ a": "footnote", "주1) a": None}),
        (lambda c: S.statement_code(c)["variant"], {"{XBRL}IS1": 1, "{XBRL}IS_C3": 3, "{XBRL}BS": None, "{XBRL}IS_C12": None}),
        (lambda c: S.statement_code(c)["basis_source"], {"{XBRL}IS1": "inferred_no_suffix", "{XBRL}BS_S": "suffix", "{XBRL}NT_1": None}),
        (S.clean, {"a\x01b\x0bc\ufeff": "abc", "a\u00a0\u3000b": "a b"}),
        (S.flat, {"a \t b\n c ": "a b c"}),
        (S.period_label, {"제 17 기 1분기 3개월 매출액은 100": "제 17 기 1분기 3개월", "2023.03.31 현재": None, "매출 제17기말 증가": "제17기말", "제 1 기 기초 2023.1.2 ~": "제 1 기 기초"}),
        (lambda c: S.period_label(c, caption=True), {"제 3 기 전체 기간": "제 3 기 전체 기간"}),
        (S.period_labels, {"제 1 기와 제2기 반기 누적": ["제 1 기", "제2기 반기 누적"]}),
        (S.normal_label, {"Ⅵ.1.기말현금 (주 5,27)": "기말현금", "VI.기초의현금": "기초의현금", "가.나": "나"}),
    ],
)
def test_definitions(spark, column, cases):
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", column(F.col("t")).alias("v"))
    assert {r.t: r.v for r in rows.collect()} == cases
