"""Checks of statements: signed sums by rule, totals across columns, confidence; keyed facts; corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions.scalars import normal_label

#: The labels under which the filings state each amount.
LABELS = {
    "net_income": ["당기순이익(손실)", "당기순이익", "분기순이익(손실)", "분기순이익", "반기순이익(손실)", "반기순이익", "당기순손익"],
    "pretax": ["법인세비용차감전순이익(손실)", "법인세비용차감전순이익", "법인세차감전순이익(손실)", "법인세차감전순이익", "법인세비용차감전계속영업이익(손실)"],
    "revenue": ["수익(매출액)", "매출액", "영업수익", "수익", "매출", "영업수익(매출액)"],
    "oci": ["기타포괄손익", "분기기타포괄손익", "반기기타포괄손익", "당기기타포괄손익", "세후기타포괄손익"],
    "tci": ["총포괄손익", "총포괄이익", "분기총포괄이익", "반기총포괄이익", "당기총포괄이익", "총포괄손익(손실)", "분기총포괄손익", "반기총포괄손익", "당기총포괄손익"],
    "owner": ["지배기업의소유주지분", "지배기업소유주지분", "지배기업의소유주에게귀속되는당기순이익(손실)", "지배기업소유주에게귀속되는당기순이익", "지배주주지분"],
    "noncontrolling": ["비지배지분", "비지배주주지분"],
    "assets": ["자산총계", "자산총계(자산)"],
    "current_assets": ["유동자산"],
    "noncurrent_assets": ["비유동자산"],
    "held_assets": ["매각예정으로분류된처분집단의자산", "매각예정비유동자산", "매각예정으로분류된자산"],
    "liabilities": ["부채총계"],
    "current_liabilities": ["유동부채"],
    "noncurrent_liabilities": ["비유동부채"],
    "held_liabilities": ["매각예정으로분류된처분집단에포함된부채", "매각예정부채"],
    "equity": ["자본총계"],
    "owner_equity": ["지배기업의소유주에게귀속되는자본", "지배기업소유주지분", "지배기업의소유주지분"],
    "liabilities_equity": ["자본과부채총계", "부채와자본총계", "부채및자본총계", "자본과부채총계(부채와자본총계)"],
    "gross_profit": ["매출총이익", "매출총이익(손실)"],
    "cost_of_sales": ["매출원가"],
    "operating_profit": ["영업이익", "영업이익(손실)"],
    "sga": ["판매비와관리비", "판매비와일반관리비"],
    "tax": ["법인세비용", "법인세비용(수익)"],
    "not_reclassified": ["후속적으로당기손익으로재분류되지않는항목", "당기손익으로재분류되지않는항목", "후속기간에당기손익으로재분류되지않는항목", "당기손익으로재분류되지않는항목(세후기타포괄손익"],
    "reclassified": ["후속적으로당기손익으로재분류될수있는항목", "후속적으로당기손익으로재분류되는항목", "당기손익으로재분류될수있는항목", "후속기간에당기손익으로재분류되는항목", "당기손익으로재분류될수있는항목(세후기타포괄"],
    "nonoperating": ["영업외손익", "영업외수익", "기타영업외손익"],
    "tci_owner": ["총포괄손익,지배기업의소유주에게귀속되는지분", "총포괄손익지배기업의소유주지분", "총포괄손익의귀속지배기업의소유주지분"],
    "tci_noncontrolling": ["총포괄손익,비지배지분", "총포괄손익비지배지분"],
    "cf_operating": ["영업활동현금흐름", "영업활동으로인한현금흐름", "영업활동으로인한순현금흐름", "영업활동순현금흐름"],
    "cf_investing": ["투자활동현금흐름", "투자활동으로인한현금흐름", "투자활동으로인한순현금흐름", "투자활동순현금흐름"],
    "cf_financing": ["재무활동현금흐름", "재무활동으로인한현금흐름", "재무활동으로인한순현금흐름", "재무활동순현금흐름"],
    "cf_net": ["현금및현금성자산의순증가(감소)", "현금및현금성자산의증가(감소)", "현금및현금성자산의순증감", "현금및현금성자산의증감", "현금및현금성자산의순증가", "현금의증가(감소)", "현금및현금성자산의증가", "현금및현금성자산의감소", "현금및현금성자산의순변동"],
    "cf_exchange": ["현금및현금성자산에대한환율변동효과", "외화표시현금및현금성자산의환율변동효과", "현금및현금성자산의환율변동효과"],
    "cf_begin": ["기초현금및현금성자산", "기초의현금및현금성자산", "기초의현금및현금성자산잔액", "현금및현금성자산의기초잔액", "기초현금및현금성자산잔액"],
    "cf_end": ["기말현금및현금성자산", "기말의현금및현금성자산", "기말의현금및현금성자산잔액", "현금및현금성자산의기말잔액", "분기말현금및현금성자산", "분기말의현금및현금성자산", "반기말현금및현금성자산", "반기말의현금및현금성자산", "당기말현금및현금성자산", "당기말의현금및현금성자산"],
    "cf_before_exchange": ["환율변동효과반영전현금및현금성자산의순증가(감소)", "환율변동효과반영전현금및현금성자산의증가(감소)"],
}
#: The accounting identities that the filings' statements state, over the labels above: statement, name, total,
#: terms (sign, amount), optional terms, and a group of alternatives of which one must hold.
RULES = [
    ("BS", "assets", "assets", [(+1, "current_assets"), (+1, "noncurrent_assets")], ["held_assets"], None),
    ("BS", "liabilities", "liabilities", [(+1, "current_liabilities"), (+1, "noncurrent_liabilities")], ["held_liabilities"], None),
    ("BS", "equity", "equity", [(+1, "owner_equity"), (+1, "noncontrolling")], [], None),
    ("BS", "balance", "liabilities_equity", [(+1, "liabilities"), (+1, "equity")], [], None),
    ("IS", "gross profit", "gross_profit", [(+1, "revenue"), (-1, "cost_of_sales")], [], None),
    ("IS", "operating profit", "operating_profit", [(+1, "gross_profit"), (-1, "sga")], [], None),
    ("IS", "net income", "net_income", [(+1, "pretax"), (-1, "tax")], [], None),
    ("IS", "net income by owner", "net_income", [(+1, "owner"), (+1, "noncontrolling")], [], None),
    ("IS", "comprehensive income", "tci", [(+1, "net_income"), (+1, "oci")], [], None),
    ("IS", "other comprehensive income", "oci", [(+1, "not_reclassified"), (+1, "reclassified")], [], None),
    ("IS", "pretax", "pretax", [(+1, "operating_profit"), (+1, "nonoperating")], [], None),
    ("IS", "comprehensive income by owner", "tci", [(+1, "tci_owner"), (+1, "tci_noncontrolling")], [], None),
    ("CF", "before exchange", "cf_before_exchange", [(+1, "cf_operating"), (+1, "cf_investing"), (+1, "cf_financing")], [], None),
    ("CF", "net change", "cf_net", [(+1, "cf_before_exchange"), (+1, "cf_exchange")], [], "cf_net"),
    ("CF", "net change without exchange", "cf_net", [(+1, "cf_operating"), (+1, "cf_investing"), (+1, "cf_financing")], [], "cf_net"),
    ("CF", "net change with exchange", "cf_net", [(+1, "cf_operating"), (+1, "cf_investing"), (+1, "cf_financing"), (+1, "cf_exchange")], [], "cf_net"),
    ("CF", "end", "cf_end", [(+1, "cf_begin"), (+1, "cf_net")], [], "cf_end"),
    ("CF", "end with exchange", "cf_end", [(+1, "cf_begin"), (+1, "cf_net"), (+1, "cf_exchange")], [], "cf_end"),
]


def rule_terms(spark: SparkSession, rules: list[tuple] = RULES, labels: dict[str, list[str]] = LABELS) -> DataFrame:
    """The rules as rows: rule, statement, alternative, role (total, term, optional), sign, slot, label and its priority."""
    rows = []
    for n, (statement, name, total, terms, optional, alternative) in enumerate(rules):
        slots = [("total", 0, total)] + [("term", sign, t) for sign, t in terms] + [("optional", 1, t) for t in optional]
        rows += [(n, statement, name, alternative, role, sign, k, label, p) for k, (role, sign, slot) in enumerate(slots) for p, label in enumerate(labels[slot])]
    return spark.createDataFrame(rows, "rule int, statement string, name string, alternative string, role string, sign int, slot int, label string, priority int").withColumn("label", normal_label(F.col("label")))


def identities(rows: DataFrame, terms: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """group, column, rule, name, total, sum and status of each rule that can be read off.

    rows: group, statement, row, column, label, value. A slot takes its first candidate that the group
    has, and that label's first row. A rule whose total or a term is missing gives no row. Optional
    terms may be in or out; of alternatives one must hold: status is pass, fail, or alternative for a
    failing one whose fellow passes.
    """
    normal = rows.withColumn("label", normal_label(F.col("label")))
    first = Window.partitionBy("group", "column", "rule", "slot").orderBy("priority", "row")
    met = normal.join(terms, ["statement", "label"]).withColumn("k", F.row_number().over(first)).filter("k = 1 and value is not null")
    need = terms.select("rule", "slot", "role").distinct().filter("role != 'optional'").groupBy("rule").agg(F.count("*").alias("need"))
    found = met.groupBy("group", "column", "rule", "name", "alternative").agg(
        F.sum(F.when(F.col("role") == "total", F.col("value"))).alias("total"),
        F.sum(F.when(F.col("role") == "term", F.col("sign") * F.col("value"))).alias("sum"),
        F.coalesce(F.sum(F.when(F.col("role") == "optional", F.col("value"))), F.lit(0.0)).alias("extra"),
        F.count_if(F.col("role") != "optional").alias("n"),
    ).join(need, "rule").filter("n = need")
    holds = (F.abs(F.col("total") - F.col("sum")) <= tolerance) | (F.abs(F.col("total") - F.col("sum") - F.col("extra")) <= tolerance)
    fellow = F.bool_or(F.when(F.col("alternative").isNotNull(), F.col("holds"))).over(Window.partitionBy("group", "column", F.coalesce("alternative", F.col("rule").cast("string"))))
    found = found.withColumn("holds", holds)
    status = F.when(F.col("holds"), "pass").when(F.coalesce(fellow, F.lit(False)), "alternative").otherwise("fail")
    return found.select("group", "column", "rule", "name", "total", "sum", status.alias("status"))


def column_total(values: Column, tolerance: float = 1.0) -> Column:
    """Whether the last value is the sum of the others; null counts as zero, null if all are null."""
    rest = F.slice(values, F.lit(1), F.size(values) - 1)
    total = F.coalesce(F.element_at(values, -1), F.lit(0.0))
    added = F.aggregate(rest, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    return F.when(F.exists(values, lambda v: v.isNotNull()), F.abs(total - added) <= tolerance)


def confidence(n_checks: Column, n_failed: Column, has_unit: Column, has_periods: Column) -> Column:
    """low, unverified or high, with the reasons."""
    reasons = F.array_compact(F.array(F.when(n_failed > 0, "checks failed"), F.when(~has_unit, "no unit"), F.when(~has_periods, "no periods"), F.when(n_checks == 0, "nothing checked")))
    grade = F.when((n_failed > 0) | ~has_unit | ~has_periods, "low").when(n_checks == 0, "unverified").otherwise("high")
    return F.struct(grade.alias("grade"), reasons.alias("reasons"))


def key_statistics(facts: DataFrame, by: list[str], code: str, row: list[str], column: str) -> DataFrame:
    """How well keys tell facts apart: all facts; distinct codes, triples and quadruples; repeats in a row; what each key loses."""
    counted = facts.groupBy(*by).agg(
        F.count("*").alias("n"), F.countDistinct(code).alias("n_codes"), F.countDistinct(*row, code).alias("n_triples"), F.countDistinct(*row, column, code).alias("n_quads")
    )
    lost = lambda c: F.bround(1 - F.col(c) / F.col("n"), 6)
    return counted.select(*by, "n", "n_codes", "n_triples", "n_quads", (F.col("n") - F.col("n_triples")).alias("n_repeats"), lost("n_codes").alias("lost_by_code"), lost("n_triples").alias("lost_by_triple"))


def facts_by_row(facts: DataFrame, row: list[str], column: str, value: str, label: str) -> DataFrame:
    """A row's facts: its first label and its values by column."""
    return facts.groupBy(*row).agg(F.min_by(label, column).alias("label"), F.array_sort(F.collect_list(F.struct(column, value))).alias("cells"))


def corrections(tables: DataFrame, before: str, after: str, item: str, reason: str | None = None) -> DataFrame:
    """Pairs of a comparison table: rows with something before or after; changed compares trimmed texts."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit(""))
    rows = tables.filter((blank(before) != "") | (blank(after) != ""))
    return rows.withColumn("item", blank(item)).withColumn("reason", F.nullif(blank(reason), F.lit("")) if reason else F.lit(None).cast("string")).withColumn("changed", blank(before) != blank(after))
