"""Drift on order lines (shipped before or in the last year), on labelled
against unlabelled documents, and on event days against the first week."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.shape import rounded
from tidemark.functions.stage import new_path
from tidemark.operators import drift
from tidemark.operators.reference import store_reference
from tidemark.plans.registry import Registry
from tidemark.plans.sqltext import big, long, r, with_
from tidemark.roles import DRIFT_ADVICE
from tidemark.sources.tables import table

REGISTRY = Registry()
query = REGISTRY.query


NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT = ["l_returnflag", "l_linestatus"]


def _line_sides(spark, sf, more=()):
    lines = table(spark, sf, "lineitem").select(*NUM, *CAT, *more, "l_shipdate")
    cut = lines.agg(F.max("l_shipdate")).scalar() - F.expr("interval 365 days")
    return lines.where(F.col("l_shipdate") <= cut), lines.where(F.col("l_shipdate") > cut)


def _document_sides(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    marked = table(spark, sf, "labels").select("doc_id")
    return docs.join(marked, "doc_id", "left_anti"), docs.join(marked, "doc_id", "left_semi")


LINES = f"""sides AS (SELECT *, l_shipdate > (SELECT max(l_shipdate) - INTERVAL 365 DAY FROM lineitem) AS cur FROM lineitem),
num AS ({long(NUM, 'sides', 'cur')}), cat AS ({long(CAT, 'sides', 'cur', 'VARCHAR')})"""
DOCS = f"""sides AS (SELECT *, doc_id IN (SELECT doc_id FROM labels) AS cur FROM documents),
num AS ({long(['n_chars'], 'sides', 'cur')}), cat AS ({long(['lang', 'source'], 'sides', 'cur', 'VARCHAR')})"""


def _psi_sql(counts: str, name: str) -> str:
    return f"""{name}_s AS (SELECT feature AS f, sum(nr) AS sr, sum(nc) AS sc FROM {counts} GROUP BY 1),
{name}_e AS (SELECT feature, greatest(nr / sr::DOUBLE, 1e-6) AS e, greatest(nc / sc::DOUBLE, 1e-6) AS a
  FROM {counts} JOIN {name}_s ON feature = f WHERE label IS NOT NULL),
{name} AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM {name}_e GROUP BY 1)"""


PSI_NUM = """span AS (SELECT feature AS f, min(value) AS lo, max(value) AS hi FROM num WHERE NOT cur AND value IS NOT NULL GROUP BY 1),
edges AS (SELECT f, i, i * ((hi - lo) / 10) + lo AS e, lo, hi FROM span, range(1, 10) t(i)),
placed AS (SELECT feature, value, cur, CASE WHEN value BETWEEN lo AND hi THEN 1 END AS inside,
  (SELECT count(*) FROM edges WHERE edges.f = feature AND edges.e <= value) AS bin FROM num JOIN span ON feature = f
  WHERE value IS NOT NULL),
num_counts AS (SELECT feature, CASE WHEN inside = 1 THEN bin END AS label, sum(CASE WHEN cur THEN 0 ELSE 1 END) AS nr,
  sum(CASE WHEN cur THEN 1 ELSE 0 END) AS nc FROM placed GROUP BY 1, 2),
""" + _psi_sql("num_counts", "psi_num")
PSI_CAT = """cat_counts AS (SELECT feature, value AS label, sum(CASE WHEN cur THEN 0 ELSE 1 END) AS nr,
  sum(CASE WHEN cur THEN 1 ELSE 0 END) AS nc FROM cat WHERE value IS NOT NULL GROUP BY 1, 2),
""" + _psi_sql("cat_counts", "psi_cat")


def _ks_sql(source: str, name: str) -> str:
    return f"""{name}_v AS (SELECT feature, value, sum(CASE WHEN cur THEN 0 ELSE 1 END) AS nr,
  sum(CASE WHEN cur THEN 1 ELSE 0 END) AS nc FROM {source} WHERE value IS NOT NULL GROUP BY 1, 2),
{name}_c AS (SELECT feature, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc, sum(nr) OVER (PARTITION BY feature) AS tr,
  sum(nc) OVER (PARTITION BY feature) AS tc FROM {name}_v WINDOW w AS (PARTITION BY feature ORDER BY value
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_d AS (SELECT feature, max(abs(cr / tr::DOUBLE - cc / tc::DOUBLE)) AS ks, max(tr)::DOUBLE AS n, max(tc)::DOUBLE AS m
  FROM {name}_c GROUP BY 1),
{name}_l AS (SELECT feature, ks, ks * sqrt(n * m / (n + m)) AS lam FROM {name}_d),
{name} AS (SELECT feature AS kf, ks, CASE WHEN lam < 0.2 THEN 1 ELSE least(greatest(list_sum(list_transform(range(1, 101),
  lambda j : CASE WHEN j % 2 = 1 THEN 2e0 ELSE -2e0 END * exp(-2e0 * j * j * lam * lam))), 0), 1) END AS p FROM {name}_l)"""


@query("psi_numeric", with_(LINES, PSI_NUM) + f"SELECT feature, {r('psi')} AS psi FROM psi_num")
def psi_numeric(spark, sf):
    return rounded(drift.psi_numeric(*_line_sides(spark, sf), NUM))


@query("psi_categorical", with_(DOCS, PSI_CAT) + f"SELECT feature, {r('psi')} AS psi FROM psi_cat")
def psi_categorical(spark, sf):
    return rounded(drift.psi_categorical(*_document_sides(spark, sf), ["lang", "source"]))


SEVERITY = "CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'low' WHEN psi < 0.25 THEN 'moderate' ELSE 'high' END"


@query("drift_severity", with_(DOCS, PSI_NUM, PSI_CAT) + f"""SELECT feature, {SEVERITY} AS severity
FROM (SELECT * FROM psi_num UNION ALL SELECT * FROM psi_cat)""")
def drift_severity(spark, sf):
    reference, current = _document_sides(spark, sf)
    psi = drift.psi_numeric(reference, current, ["n_chars"]).unionByName(
        drift.psi_categorical(reference, current, ["lang", "source"])
    )
    return psi.select("feature", drift.drift_severity(F.col("psi")).alias("severity"))


@query("ks_numeric", with_(LINES, _ks_sql("num", "ks")) + f"""SELECT kf AS feature, {r('ks')} AS ks,
{r('p')} AS ks_pvalue FROM ks""")
def ks_numeric(spark, sf):
    return rounded(drift.ks_numeric(*_line_sides(spark, sf), NUM))


@query("ks_categorical", with_(DOCS, _ks_sql("cat", "ks")) + f"""SELECT kf AS feature, {r('ks')} AS ks,
{r('p')} AS ks_pvalue FROM ks""")
def ks_categorical(spark, sf):
    return rounded(drift.ks_categorical(*_document_sides(spark, sf), ["lang", "source"]))


REPORT = ", ".join([PSI_NUM, PSI_CAT, _ks_sql("num", "ks_n"), _ks_sql("cat", "ks_k")]) + f""",
both_sides AS (SELECT feature, 'numeric' AS kind, psi, ks, p FROM psi_num JOIN ks_n ON feature = kf
  UNION ALL SELECT feature, 'categorical', psi, ks, p FROM psi_cat JOIN ks_k ON feature = kf),
report AS (SELECT *, {SEVERITY} AS severity FROM both_sides)"""


def _report_sql(sides: str) -> str:
    return with_(sides, REPORT) + f"""SELECT feature, kind, {r('psi', 4)} AS psi, {r('ks', 4)} AS ks_statistic,
    {r('p', 4)} AS ks_pvalue, severity, {big("CASE WHEN severity IN ('moderate', 'high') THEN 1 ELSE 0 END")} AS has_drift,
    {big('CASE WHEN p < 0.05 THEN 1 ELSE 0 END')} AS ks_significant FROM report"""


@query("drift_report", _report_sql(LINES))
def drift_report(spark, sf):
    return rounded(drift.drift_report(*_line_sides(spark, sf), NUM, CAT))


@query("drift_report_documents", _report_sql(DOCS))
def drift_report_documents(spark, sf):
    return rounded(drift.drift_report(*_document_sides(spark, sf), ["n_chars"], ["lang", "source"]))


@query("drift_report_stored", _report_sql(LINES))
def drift_report_stored(spark, sf):
    """The newest lines against a store of the older ones, which is written once and read instead of them."""
    reference, current = _line_sides(spark, sf)
    return rounded(store_reference(reference, NUM, CAT, new_path(spark, "reference")).report(current))


def _exact_sql(n: str, m: str) -> str:
    """Lattice paths inside the band, row by row, as shares of all paths."""
    start = f"list_transform(range({m} + 1), lambda j : CASE WHEN j * {n} < steps THEN 1e0 ELSE 0e0 END)"
    row = f"list_transform(range({m} + 1), lambda j : CASE WHEN abs((i + 1) * {m} - j * {n}) < steps THEN list_sum(list_transform(range(j + 1), lambda k : CASE WHEN k >= low THEN p[k + 1] ELSE 0e0 END)) ELSE 0e0 END * (i + 1) / (i + 1 + {m}))"
    low = f"coalesce(list_min(list_filter(range({m} + 1), lambda j : abs((i + 1) * {m} - j * {n}) < steps)), {m} + 1)"
    return f"""walk AS (SELECT feature, steps, n, m, 0 AS i, {start} AS p FROM sized
UNION ALL SELECT feature, steps, n, m, i + 1, {row} FROM (SELECT *, {low} AS low FROM walk WHERE i < n)),
exact AS (SELECT feature, greatest(least(1 - p[m + 1], 1), 0) AS p FROM walk WHERE i = n)"""


@query("ks_exact", f"""WITH RECURSIVE sides AS (SELECT s_acctbal, CAST(n_regionkey AS VARCHAR) AS region, n_regionkey < 2 AS cur FROM supplier JOIN nation ON s_nationkey = n_nationkey),
num AS ({long(['s_acctbal'], 'sides', 'cur')}), {_ks_sql('num', 'ks')},
sized AS (SELECT feature, round(ks * n * m)::BIGINT AS steps, n::BIGINT AS n, m::BIGINT AS m FROM ks_d),
{_exact_sql('n', 'm')}
SELECT feature, {r('ks')} AS ks, {r('e.p')} AS ks_pvalue FROM ks JOIN exact e ON feature = kf""")
def ks_exact(spark, sf):
    """Balances of suppliers of two regions against the others, with the share of all orderings."""
    sides = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rounded(drift.ks_numeric(sides.where("n_regionkey >= 2"), sides.where("n_regionkey < 2"), ["s_acctbal"], exact=True))


_ADVICE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DRIFT_ADVICE.items())


@query("drift_overall", with_(DOCS, REPORT, """counts AS (SELECT count(*) AS checked,
  sum(CASE WHEN severity <> 'none' THEN 1 ELSE 0 END) AS drifted, sum(CASE WHEN severity = 'none' THEN 1 ELSE 0 END) AS n0,
  sum(CASE WHEN severity = 'low' THEN 1 ELSE 0 END) AS n1, sum(CASE WHEN severity = 'moderate' THEN 1 ELSE 0 END) AS n2,
  sum(CASE WHEN severity = 'high' THEN 1 ELSE 0 END) AS n3 FROM report),
levels AS (SELECT *, CASE WHEN n3 >= 2 THEN 'high' WHEN n3 > 0 OR n2 >= 2 THEN 'moderate' WHEN n2 > 0 OR n1 > 0 THEN 'low'
  ELSE 'none' END AS o FROM counts)""") + f"""SELECT checked AS features_checked, {big('drifted')} AS features_with_drift,
{big('n0')} AS n_none, {big('n1')} AS n_low, {big('n2')} AS n_moderate, {big('n3')} AS n_high, o AS overall_severity,
{r('drifted * 100 / checked::DOUBLE', 2)} AS drift_percentage, CASE o {_ADVICE} END AS recommendation FROM levels""")
def drift_overall(spark, sf):
    report = drift.drift_report(*_document_sides(spark, sf), ["n_chars"], ["lang", "source"])
    return rounded(drift.drift_overall(report))


_MORE = ["l_linenumber", "l_orderkey", "l_partkey", "l_suppkey"]
_WIDE = LINES.replace(f"num AS ({long(NUM, 'sides', 'cur')})", f"num AS ({long([*NUM, *_MORE], 'sides', 'cur')})")


@query("dist_compare", with_(_WIDE, PSI_NUM, PSI_CAT, """ranked AS (SELECT feature AS rf, row_number() OVER (ORDER BY psi DESC, feature)
  AS rn FROM (SELECT * FROM psi_num UNION ALL SELECT * FROM psi_cat)),
wide AS (SELECT feature AS f, min(value) AS lo, max(value) AS hi FROM num WHERE value IS NOT NULL GROUP BY 1),
wedges AS (SELECT f, i * ((hi - lo) / 10) + lo AS e FROM wide, range(1, 10) t(i)),
cells AS (SELECT feature, cur, CAST((SELECT count(*) FROM wedges WHERE wedges.f = feature AND wedges.e <= value) AS VARCHAR)
  AS label, (hi - lo) / 10 AS width FROM num JOIN wide ON feature = wide.f WHERE value IS NOT NULL
  UNION ALL SELECT feature, cur, value, NULL FROM cat WHERE value IS NOT NULL),
sized AS (SELECT feature, cur, label, width, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature, cur) AS s
  FROM cells GROUP BY 1, 2, 3, 4)""") + f"""SELECT feature, CASE WHEN cur THEN 'current' ELSE 'reference' END AS source, label,
{r('n / s::DOUBLE')} AS share, {r('n / s::DOUBLE / width', 9)} AS density
FROM sized JOIN ranked ON feature = rf WHERE rn <= 6""")
def dist_compare(spark, sf):
    """The six columns of ten that moved most."""
    out = drift.distribution_compare(*_line_sides(spark, sf, _MORE), [*NUM, *_MORE], CAT)
    return rounded(out.withColumn("share", F.round("share", 6)), 9)


WINDOWED = with_("""days AS (SELECT date_trunc('day', ts) AS d, value, event_type,
  date_trunc('day', ts) >= (SELECT date_trunc('day', min(ts)) + INTERVAL 7 DAY FROM events) AS cur FROM events),
span AS (SELECT min(value) AS lo, max(value) AS hi FROM days WHERE NOT cur),
edges AS (SELECT i * ((hi - lo) / 10) + lo AS e FROM span, range(1, 10) t(i)),
cells AS (SELECT d, cur, 'value' AS feature, CASE WHEN value BETWEEN lo AND hi THEN
  CAST((SELECT count(*) FROM edges WHERE e <= value) AS VARCHAR) END AS label FROM days, span WHERE value IS NOT NULL
  UNION ALL SELECT d, cur, 'event_type', event_type FROM days WHERE event_type IS NOT NULL),
ref AS (SELECT feature, label, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature) AS s FROM cells WHERE NOT cur GROUP BY 1, 2),
win AS (SELECT d, feature, label, count(*) AS n FROM cells WHERE cur GROUP BY 1, 2, 3),
size AS (SELECT d, feature, sum(n) AS s FROM win GROUP BY 1, 2),
labels_all AS (SELECT DISTINCT feature, label FROM cells WHERE label IS NOT NULL),
pairs AS (SELECT size.d, size.feature, greatest(coalesce(ref.n, 0) / (SELECT max(s) FROM ref q WHERE q.feature = size.feature)::DOUBLE, 1e-6) AS e,
  greatest(coalesce(win.n, 0) / size.s::DOUBLE, 1e-6) AS a FROM size JOIN labels_all l ON l.feature = size.feature
  LEFT JOIN ref ON ref.feature = size.feature AND ref.label = l.label
  LEFT JOIN win ON win.d = size.d AND win.feature = size.feature AND win.label = l.label),
scored AS (SELECT d, feature, sum((a - e) * ln(a / e)) AS psi FROM pairs GROUP BY 1, 2)""") + f"SELECT strftime(d, '%Y-%m-%d') AS window_start, feature, {r('psi')} AS psi, {SEVERITY} AS severity FROM scored"


def event_sides(spark, sf):
    """Events of the first week, and those after it."""
    events = table(spark, sf, "events").select("ts", "value", "event_type")
    edge = F.date_trunc("day", events.agg(F.min("ts")).scalar()) + F.expr("interval 7 days")
    return events.where(F.col("ts") < edge), events.where(F.col("ts") >= edge)


@query("drift_by_window", WINDOWED)
def drift_by_window(spark, sf):
    reference, current = event_sides(spark, sf)
    out = drift.drift_by_window(reference, current, "ts", ["value"], ["event_type"])
    return rounded(out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")))
