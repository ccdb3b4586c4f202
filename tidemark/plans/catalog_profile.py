"""Sources, cleaning, profiling and information value on the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.functions.shape import rounded
from tidemark.functions.stage import staged
from tidemark.operators import clean, iv, profile
from tidemark.plans.registry import Registry
from tidemark.plans.sqltext import C360, big, long, quantile, r, with_
from tidemark.roles import ORDERS360
from tidemark.sources.customer360 import customer360
from tidemark.sources.tables import table

CATEGORICAL = ["contract", "internet", "payment", "paperless", "partner", "dependents"]
NUMERIC = ["tenure", "recency", "monthly", "total", "balance"]
RECENCY = replace(ORDERS360, tenure="recency", total="total_text")

REGISTRY = Registry()
query = REGISTRY.query


@query(
    "src_customer360",
    with_(C360)
    + f"""SELECT customer_key, {big('target')} AS target, {big('tenure')} AS tenure, {big('recency')} AS recency,
    {r('monthly')} AS monthly, {r('total')} AS total, total_text, {r('balance')} AS balance, contract, internet,
    payment, paperless, partner, dependents, {big('senior')} AS senior, svc_urgent, svc_high, svc_medium,
    svc_unspecified, svc_low FROM c360""",
)
def src_customer360(spark, sf):
    return rounded(customer360(spark, sf))


def _range_sql(c, low, high):
    return (
        f"SELECT customer_key, '{c}' AS column_name, 'min' AS rule FROM c360 WHERE {c} < {low} UNION ALL "
        f"SELECT customer_key, '{c}', 'max' FROM c360 WHERE {c} > {high}"
    )


@query(
    "row_violations",
    with_(C360)
    + " UNION ALL ".join(
        [_range_sql(c, lo, hi) for c, (lo, hi) in ORDERS360.numeric_ranges.items()]
        + [
            f"SELECT customer_key, '{c}', 'valid' FROM c360 WHERE {c} NOT IN ({', '.join(map(repr, v))})"
            for c, v in ORDERS360.valid_values.items()
        ]
    ),
)
def row_violations(spark, sf):
    return clean.row_violations(customer360(spark, sf), ORDERS360)


@query(
    "batch_union",
    f"SELECT o_orderkey, o_custkey, {r('o_totalprice')} AS o_totalprice, o_orderstatus AS batch FROM orders "
    "WHERE o_orderstatus IN ('F', 'O', 'P')",
)
def batch_union(spark, sf):
    orders = table(spark, sf, "orders")
    parts = [
        orders.where(F.col("o_orderstatus") == s).select(
            "o_orderkey", "o_custkey", "o_totalprice", F.lit(s).alias("batch")
        )
        for s in ("F", "O", "P")
    ]
    return rounded(clean.batch_union(parts))


@query(
    "fix_total",
    with_(C360)
    + f"""SELECT customer_key, {big('recency')} AS recency,
    {r('''CASE WHEN recency = 0 AND try_cast(total_text AS DOUBLE) IS NULL THEN 0
    ELSE try_cast(total_text AS DOUBLE) END''')} AS total_text FROM c360""",
)
def fix_total(spark, sf):
    fixed = clean.fix_total(customer360(spark, sf), RECENCY)
    return rounded(fixed.select("customer_key", "recency", "total_text"))


@query(
    "blank_to_null",
    with_(C360)
    + """SELECT customer_key, total_text, contract, payment FROM c360
    WHERE NOT regexp_full_match(total_text, '\\s*') AND NOT regexp_full_match(contract, '\\s*')
    AND NOT regexp_full_match(payment, '\\s*')""",
)
def blank_to_null(spark, sf):
    return clean.complete_cases(
        customer360(spark, sf).select("customer_key", "total_text", "contract", "payment")
    )


@query(
    "target_binary",
    f"SELECT event_id, {big('CASE WHEN lower(event_type) = lower(' + repr('PURCHASE') + ') THEN 1 ELSE 0 END')} "
    "AS event_type FROM events",
)
def target_binary(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return rounded(clean.binary_target(events, "event_type", positive="PURCHASE"))


def _labelled_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


_LABELLED = """docs AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@query(
    "drop_null_target",
    with_(_LABELLED) + f"SELECT doc_id, lang, {big('quality')} AS quality FROM docs WHERE quality IS NOT NULL",
)
def drop_null_target(spark, sf):
    docs = _labelled_documents(spark, sf).select("doc_id", "lang", "quality")
    return rounded(clean.drop_null_target(docs, "quality"))


@query(
    "non_numeric_audit",
    with_(C360)
    + f"""SELECT total_text AS raw_value, {big('recency')} AS recency, count(*) AS n FROM c360
    WHERE total_text IS NOT NULL AND try_cast(total_text AS DOUBLE) IS NULL GROUP BY 1, 2""",
)
def non_numeric_audit(spark, sf):
    return rounded(clean.non_numeric_audit(customer360(spark, sf), "total_text", "recency"))


@query(
    "sample_complete",
    with_(C360)
    + f"""SELECT customer_key, total_text, contract, {big('target')} AS target FROM c360
    WHERE NOT regexp_full_match(total_text, '\\s*')
    ORDER BY md5(concat(customer_key, '-42')) LIMIT 100""",
)
def sample_complete(spark, sf):
    base = customer360(spark, sf).select("customer_key", "total_text", "contract", "target")
    return rounded(clean.sample_complete(base, "customer_key", 100))


@query(
    "missing_profile",
    with_(_LABELLED)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, "
        f"{r(f'round((count(*) - count({c})) / count(*)::DOUBLE * 100, 2)')} AS pct FROM docs HAVING count({c}) < count(*)"
        for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    ),
)
def missing_profile(spark, sf):
    return rounded(profile.missing_profile(_labelled_documents(spark, sf)))


@query("dup_keys", "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicates FROM lineitem")
def dup_keys(spark, sf):
    return profile.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_numeric",
    with_(f"cells AS ({long(_LINE_NUMBERS, 'lineitem')})")
    + f"""SELECT feature, count(value) AS count, {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std,
    {r('min(value)')} AS min, {r('max(value)')} AS max, {r('quantile_cont(value, 0.25)')} AS q25,
    {r('quantile_cont(value, 0.5)')} AS q50, {r('quantile_cont(value, 0.75)')} AS q75
    FROM cells GROUP BY feature""",
)
def describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(table(spark, sf, "lineitem"), _LINE_NUMBERS))


@query(
    "describe_text",
    with_(
        f"cells AS ({long(['lang', 'source', 'text'], 'documents', kind='VARCHAR')})",
        "counted AS (SELECT feature, value, count(*) AS n FROM cells WHERE value IS NOT NULL GROUP BY 1, 2)",
        """placed AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rn,
        sum(n) OVER (PARTITION BY feature) AS total, count(*) OVER (PARTITION BY feature) AS uniq FROM counted)""",
    )
    + f"""SELECT feature, {big('total')} AS count, uniq AS "unique", value AS top, n AS freq FROM placed WHERE rn = 1""",
)
def describe_text(spark, sf):
    return profile.describe_text(table(spark, sf, "documents"), ["lang", "source", "text"])


@query(
    "value_counts",
    f"""SELECT CAST(o_custkey AS VARCHAR) AS value, count(*) AS n,
    {r('count(*) / (SELECT count(o_custkey) FROM orders)::DOUBLE')} AS share
    FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10""",
)
def value_counts(spark, sf):
    return rounded(profile.value_counts(table(spark, sf, "orders"), "o_custkey"))


@query(
    "target_distribution",
    with_(C360)
    + f"""SELECT {big('target')} AS target, count(*) AS n,
    {r('count(*) / (SELECT count(*) FROM c360)::DOUBLE * 100')} AS pct FROM c360 GROUP BY 1""",
)
def target_distribution(spark, sf):
    return rounded(profile.target_distribution(staged(customer360(spark, sf).select("target"), "c360"), "target"))


@query(
    "rate_by_category",
    with_(C360) + f"SELECT contract, count(*) AS n, {r('avg(target)')} AS rate FROM c360 GROUP BY 1",
)
def rate_by_category(spark, sf):
    return rounded(profile.rate_by_category(customer360(spark, sf), "contract", "target"))


@query(
    "share_within",
    with_(C360)
    + f"""SELECT payment, {big('target')} AS target, count(*) AS n,
    {r('count(*) / (sum(count(*)) OVER (PARTITION BY payment))::DOUBLE * 100')} AS pct FROM c360 GROUP BY 1, 2""",
)
def share_within(spark, sf):
    return rounded(profile.share_within(customer360(spark, sf), "payment", "target"))


@query(
    "group_mean_compare",
    with_(C360, f"cells AS ({long(NUMERIC, 'c360', 'target')})",
          """m AS (SELECT feature, avg(CASE WHEN target = 0 THEN value END) AS mean_0,
          avg(CASE WHEN target = 1 THEN value END) AS mean_1 FROM cells GROUP BY 1)""")
    + f"""SELECT feature, {r('mean_0')} AS mean_0, {r('mean_1')} AS mean_1,
    {r('(mean_1 - mean_0) / mean_0 * 100', 1)} AS diff_pct FROM m""",
)
def group_mean_compare(spark, sf):
    return rounded(profile.group_mean_compare(customer360(spark, sf), NUMERIC, "target"))


@query(
    "histogram_by_class",
    with_(
        C360,
        "span AS (SELECT min(monthly) AS lo, max(monthly) AS hi FROM c360)",
        "edges AS (SELECT i, i * ((hi - lo) / 30) + lo AS e FROM span, range(1, 30) t(i))",
        """binned AS (SELECT customer_key, target, (SELECT count(*) FROM edges WHERE monthly >= e) AS bin FROM c360)""",
    )
    + f"SELECT {big('target')} AS target, {big('bin')} AS bin, count(*) AS n FROM binned GROUP BY 1, 2",
)
def histogram_by_class(spark, sf):
    base = staged(customer360(spark, sf).select("monthly", "target"), "c360")
    return rounded(profile.histogram_by_class(base, "monthly", "target", 30))


@query(
    "box_by_class",
    with_(
        C360,
        """q AS (SELECT target AS tq, quantile_cont(total, 0.25) AS q25, quantile_cont(total, 0.5) AS q50,
        quantile_cont(total, 0.75) AS q75 FROM c360 GROUP BY 1)""",
    )
    + f"""SELECT {big('target')} AS target, {r('max(q25)')} AS q25, {r('max(q50)')} AS q50, {r('max(q75)')} AS q75,
    {r('min(CASE WHEN total >= q25 - 1.5 * (q75 - q25) AND total <= q75 + 1.5 * (q75 - q25) THEN total END)')} AS whisker_low,
    {r('max(CASE WHEN total >= q25 - 1.5 * (q75 - q25) AND total <= q75 + 1.5 * (q75 - q25) THEN total END)')} AS whisker_high
    FROM c360 JOIN q ON target = tq GROUP BY target""",
)
def box_by_class(spark, sf):
    return rounded(profile.box_by_class(customer360(spark, sf), "total", "target"))


@query(
    "corr_matrix",
    with_(C360)
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})')} AS corr FROM c360"
        for a in NUMERIC
        for b in NUMERIC
    ),
)
def corr_matrix(spark, sf):
    return rounded(profile.corr_matrix(customer360(spark, sf), NUMERIC))


_SCREENED = ["tenure", "recency", "monthly", "total_text", "senior"]


@query(
    "leakage_screen",
    with_(
        C360,
        " UNION ALL ".join(
            (f"c AS (" if i == 0 else "")
            + f"SELECT '{c}' AS feature, corr(coalesce(try_cast({c} AS DOUBLE), 0), target) AS k, "
            f"count(DISTINCT try_cast({c} AS DOUBLE)) AS d FROM c360"
            for i, c in enumerate(_SCREENED)
        )
        + ")",
    )
    + f"SELECT feature, {r('k')} AS corr, {big('CASE WHEN abs(k) > 0.95 THEN 1 ELSE 0 END')} AS suspect FROM c WHERE d > 1",
)
def leakage_screen(spark, sf):
    return rounded(profile.leakage_screen(customer360(spark, sf), _SCREENED, "target"))


_FENCES = [
    f"cells AS ({long(['l_quantity', 'l_extendedprice'], 'lineitem')})",
    "q AS (SELECT feature AS f, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM cells GROUP BY 1)",
    "fence AS (SELECT f, a - (b - a) * 1.5 AS lo, b + (b - a) * 1.5 AS hi FROM q)",
]


@query(
    "outliers_iqr",
    with_(*_FENCES)
    + f"""SELECT feature, {r('lo')} AS lower_bound, {r('hi')} AS upper_bound,
    {big('sum(CASE WHEN value < lo THEN 1 ELSE 0 END)')} AS outliers_lower,
    {big('sum(CASE WHEN value > hi THEN 1 ELSE 0 END)')} AS outliers_upper,
    {big('sum(CASE WHEN value < lo OR value > hi THEN 1 ELSE 0 END)')} AS total_outliers
    FROM cells JOIN fence ON feature = f GROUP BY feature, lo, hi""",
)
def outliers_iqr(spark, sf):
    return rounded(profile.iqr_bounds(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query(
    "outliers_iqr_rows",
    with_(
        "q AS (SELECT quantile_cont(n_chars, 0.25) AS a, quantile_cont(n_chars, 0.75) AS b FROM documents)"
    )
    + f"""SELECT doc_id, n_chars, {big('CASE WHEN n_chars < a - (b - a) * 1.5 OR n_chars > b + (b - a) * 1.5 THEN 1 ELSE 0 END')}
    AS is_outlier FROM documents, q""",
)
def outliers_iqr_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return rounded(profile.outliers_iqr(docs, "n_chars"))


@query(
    "outliers_mad",
    with_(
        f"cells AS ({long(['l_quantity', 'l_extendedprice'], 'lineitem')})",
        "med AS (SELECT feature AS f, quantile_cont(value, 0.5) AS m FROM cells GROUP BY 1)",
        "spread AS (SELECT f, max(m) AS m, quantile_cont(abs(value - m), 0.5) AS mad FROM cells JOIN med ON feature = f GROUP BY f)",
    )
    + f"""SELECT feature, {r('max(m)')} AS median, {r('max(mad)')} AS mad,
    {big('sum(CASE WHEN mad <> 0 AND abs(0.6745 * (value - m) / mad) > 3.5 THEN 1 ELSE 0 END)')} AS outliers
    FROM cells JOIN spread ON feature = f GROUP BY feature""",
)
def outliers_mad(spark, sf):
    return rounded(profile.mad_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query(
    "outliers_mad_rows",
    with_(
        "med AS (SELECT quantile_cont(n_chars, 0.5) AS m FROM documents)",
        "spread AS (SELECT m, quantile_cont(abs(n_chars - m), 0.5) AS mad FROM documents, med GROUP BY m)",
    )
    + f"""SELECT doc_id, n_chars,
    {big('CASE WHEN mad <> 0 AND abs(0.6745 * (n_chars - m) / mad) > 3.5 THEN 1 ELSE 0 END')} AS is_outlier
    FROM documents, spread""",
)
def outliers_mad_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return rounded(profile.outliers_mad(docs, "n_chars"))


@query(
    "class_ratio",
    with_(C360)
    + f"""SELECT {r('avg(target)')} AS positive_rate, {r('(1 - avg(target)) / avg(target)')} AS pos_weight,
    {r('sum(1 - target) / sum(target)::DOUBLE')} AS neg_per_pos FROM c360""",
)
def class_ratio(spark, sf):
    return rounded(profile.class_ratio(customer360(spark, sf), "target"))


def iv_sql(cells: str) -> list[str]:
    """CTEs from (feature, v, event, total) counts to (feature, iv)."""
    return [
        f"""{cells}_t AS (SELECT feature AS f, sum(event) AS ev, sum(total - event) AS ne, count(*) AS k
        FROM {cells} GROUP BY 1)""",
        f"""{cells}_d AS (SELECT feature, (event + 0.5) / (ev + 0.5 * k)::DOUBLE AS e,
        (total - event + 0.5) / (ne + 0.5 * k)::DOUBLE AS n FROM {cells} JOIN {cells}_t ON feature = f)""",
        f"{cells}_iv AS (SELECT feature, sum((e - n) * ln(e / n)) AS iv FROM {cells}_d GROUP BY 1)",
    ]


IV_CAT = [
    f"cat_cells AS ({long(CATEGORICAL, 'c360', 'target', 'VARCHAR')})",
    """cat AS (SELECT feature, value, sum(target)::DOUBLE AS event, count(target) AS total FROM cat_cells
    WHERE value IS NOT NULL GROUP BY 1, 2)""",
    *iv_sql("cat"),
]
_DECILES = ", ".join(quantile("a", i / 10) for i in range(11))
IV_NUM = [
    f"num_cells AS ({long(NUMERIC, 'c360', 'target')})",
    "num_all AS (SELECT feature, list(value ORDER BY value) AS a FROM num_cells WHERE value IS NOT NULL GROUP BY 1)",
    f"num_ends AS (SELECT feature AS f, {quantile('a', 0.01)} AS lo, {quantile('a', 0.99)} AS hi FROM num_all)",
    "num_kept AS (SELECT feature, value, target FROM num_cells JOIN num_ends ON feature = f WHERE value BETWEEN lo AND hi)",
    "num_sorted AS (SELECT feature, list(value ORDER BY value) AS a FROM num_kept GROUP BY 1)",
    f"num_edges AS (SELECT feature AS f, list_sort(list_distinct([{_DECILES}])) AS edges FROM num_sorted)",
    """num_binned AS (SELECT feature, greatest(1, len(list_filter(edges, lambda e : e < value))) AS bin, target
    FROM num_kept JOIN num_edges ON feature = f)""",
    "num_counts AS (SELECT feature, bin, sum(target)::DOUBLE AS event, count(*) AS total FROM num_binned GROUP BY 1, 2)",
    """num AS (SELECT feature, bin, event, total FROM (SELECT *, sum(total) OVER (PARTITION BY feature) AS rows_all
    FROM num_counts) WHERE total / rows_all::DOUBLE >= 0.05)""",
    *iv_sql("num"),
]


@query("iv_categorical", with_(C360, *IV_CAT) + f"SELECT feature, {r('iv')} AS iv FROM cat_iv")
def iv_categorical(spark, sf):
    return rounded(iv.iv_categorical(customer360(spark, sf), CATEGORICAL, "target"))


@query("iv_numeric", with_(C360, *IV_NUM) + f"SELECT feature, {r('iv')} AS iv FROM num_iv")
def iv_numeric(spark, sf):
    return rounded(iv.iv_numeric(customer360(spark, sf), NUMERIC, "target"))


IV_RANK = [
    *IV_CAT,
    *IV_NUM,
    """iv_rank AS (SELECT feature, kind, iv, CASE WHEN iv < 0.02 THEN 'Irrelevante' WHEN iv < 0.1 THEN 'Fraco'
    WHEN iv < 0.3 THEN 'Médio' WHEN iv < 0.5 THEN 'Forte' ELSE 'Muito Forte' END AS strength,
    row_number() OVER (ORDER BY iv DESC, feature) AS rank
    FROM (SELECT *, 'categorical' AS kind FROM cat_iv UNION ALL SELECT *, 'numeric' FROM num_iv))""",
]


def _ranking(spark, sf):
    base = staged(customer360(spark, sf).select("target", *CATEGORICAL, *NUMERIC), "c360")
    return iv.iv_rank(base, CATEGORICAL, NUMERIC, "target")


@query("iv_rank", with_(C360, *IV_RANK) + f"SELECT feature, kind, {r('iv')} AS iv, strength, rank FROM iv_rank")
def iv_rank(spark, sf):
    return rounded(_ranking(spark, sf))


@query(
    "iv_select",
    with_(C360, *IV_RANK)
    + f"SELECT feature, {r('iv')} AS iv, {big('CASE WHEN iv >= 0.02 THEN 1 ELSE 0 END')} AS kept FROM iv_rank",
)
def iv_select(spark, sf):
    return rounded(iv.iv_select(_ranking(spark, sf)))


_SELECTED = ["tenure", "monthly", "contract", "senior", "svc_low"]


@query(
    "feature_schema",
    with_(
        C360,
        *IV_RANK,
        """wanted AS (SELECT * FROM (VALUES ('tenure', 'int'), ('monthly', 'double'), ('contract', 'string'),
        ('senior', 'int'), ('svc_low', 'string')) w(f, t))""",
    )
    + f"SELECT f AS feature, t AS type, {r('iv')} AS iv FROM wanted LEFT JOIN iv_rank ON f = feature",
)
def feature_schema(spark, sf):
    base = staged(
        customer360(spark, sf).select("target", "senior", "svc_low", *CATEGORICAL, *NUMERIC), "c360"
    )
    return rounded(iv.feature_schema(base, iv.iv_rank(base, CATEGORICAL, NUMERIC, "target"), _SELECTED))
