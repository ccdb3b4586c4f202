"""Splits, preprocessing and balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.shape import rounded
from tidemark.functions.stage import staged
from tidemark.operators import balance, buckets, prep
from tidemark.operators.buckets import bucketed_neighbours
from tidemark.operators.neighbours import nearest_neighbours
from tidemark.plans.catalog_features import SPLIT, one
from tidemark.plans.registry import Registry
from tidemark.plans.sqltext import C360, big, r, with_
from tidemark.roles import ORDERS360 as R
from tidemark.sources.customer360 import customer360
from tidemark.sources.tables import table

REGISTRY = Registry()
query = REGISTRY.query


DRAWN = """drawn AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(concat(customer_key, '-42'))) AS rn,
count(*) OVER (PARTITION BY target) AS cn FROM c360)"""
NUM = ["tenure", "monthly", "total_text"]


@query("stratified_split", with_(C360, DRAWN) + f"""SELECT customer_key, {big('target')} AS target,
CASE WHEN rn <= floor(cn * 1 / 5::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM drawn""")
def stratified_split(spark, sf):
    base = staged(customer360(spark, sf).select(R.key, "target"), "c360")
    return rounded(prep.stratified_split(base, R.key, "target", 0.2, 42))


@query("fold_assign", with_(C360, DRAWN) + f"""SELECT customer_key, {big('target')} AS target, {big(' + '.join(
f'CASE WHEN rn > floor(cn * {i} / 5::DOUBLE) THEN 1 ELSE 0 END' for i in range(1, 5)))} AS fold FROM drawn""")
def fold_assign(spark, sf):
    base = staged(customer360(spark, sf).select(R.key, "target"), "c360")
    return rounded(prep.assign_folds(base, R.key, "target", 5, 42))


def _train_all(spark, sf):
    base = staged(customer360(spark, sf), "c360")
    split = prep.stratified_split(base, R.key, "target", 0.2, 42)
    return split.where("split = 'train'"), split


PREP = with_(C360, SPLIT, "num AS (SELECT *, try_cast(total_text AS DOUBLE) AS paid FROM split)",
             "tr AS (SELECT * FROM num WHERE part = 1)")


@query("impute_numeric", PREP.rstrip() + f""",
mode AS (SELECT paid AS v FROM tr WHERE paid IS NOT NULL GROUP BY paid ORDER BY count(*) DESC, paid LIMIT 1)
SELECT customer_key, {r('coalesce(paid, (SELECT avg(paid) FROM tr))')} AS by_mean,
{r('coalesce(paid, (SELECT quantile_cont(paid, 0.5) FROM tr))')} AS by_median,
{r('coalesce(paid, (SELECT v FROM mode))')} AS by_mode FROM num""")
def impute_numeric(spark, sf):
    train, rows = _train_all(spark, sf)
    fills = {s: prep.numeric_fills(train, ["total_text"], s) for s in prep.NUMERIC_FILLS}
    names = {"mean": "by_mean", "median": "by_median", "most_frequent": "by_mode"}
    return rounded(
        rows.select(R.key, *[prep.filled_number("total_text", f).alias(names[s]) for s, f in fills.items()])
    )


@query("impute_categorical", """WITH docs AS (SELECT d.doc_id, CASE WHEN quality = 1 THEN lang END AS lang
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
mode AS (SELECT lang AS v FROM docs WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
SELECT doc_id, coalesce(lang, 'missing') AS by_constant, coalesce(lang, (SELECT v FROM mode)) AS by_mode FROM docs""")
def impute_categorical(spark, sf):
    docs = (
        table(spark, sf, "documents")
        .select("doc_id", "lang")
        .join(table(spark, sf, "labels"), "doc_id", "left")
        .select("doc_id", F.when(F.col("quality") == 1, F.col("lang")).alias("lang"))
    )
    constant = prep.categorical_fills(docs, ["lang"], "constant")
    mode = prep.categorical_fills(docs, ["lang"], "most_frequent")
    return docs.select(
        "doc_id", prep.filled_text("lang", constant).alias("by_constant"), prep.filled_text("lang", mode).alias("by_mode")
    )


def _scaled_sql(centre: str, spread: str) -> str:
    med = "coalesce(paid, (SELECT quantile_cont(paid, 0.5) FROM tr))"
    cells = [("tenure", "tenure"), ("monthly", "monthly"), ("total_text", "paid_filled")]
    return PREP.rstrip() + f""",
    filled AS (SELECT *, {med} AS paid_filled FROM num), ft AS (SELECT * FROM filled WHERE part = 1)
    SELECT customer_key, """ + ", ".join(
        r(f"({c} - (SELECT {centre.format(c)} FROM ft)) / (SELECT {spread.format(c)} FROM ft)") + f" AS {name}"
        for name, c in cells
    ) + " FROM filled"


def _scaled(spark, sf, kind):
    train, rows = _train_all(spark, sf)
    fills = prep.numeric_fills(train, NUM, "median")
    fitted = prep.scales(train, NUM, kind, fills)
    filled = prep.impute_numeric(rows, NUM, fills)
    return rounded(prep.scale(filled, fitted).select(R.key, *NUM))


@query("scale_standard", _scaled_sql("avg({0})", "stddev_pop({0})"))
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query("scale_minmax", _scaled_sql("min({0})", "max({0}) - min({0})"))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query("scale_robust", _scaled_sql("quantile_cont({0}, 0.5)", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)"))
def scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", with_(C360) + "SELECT customer_key, " + ", ".join(
    [one(f"contract = '{v}'") + f" AS contract_{v}" for v in _SEGMENTS]
    + [one(f"payment = '{v}'") + f" AS payment_{v}" for v in ("F", "O", "P")]) + " FROM c360")
def one_hot(spark, sf):
    base = staged(customer360(spark, sf).select(R.key, "contract", "payment"), "c360")
    known = prep.known_categories(base, ["contract", "payment"])
    return rounded(prep.one_hot(base, ["contract", "payment"], known))


@query("one_hot_drop_first", with_(C360) + "SELECT customer_key, " + ", ".join(
    one(f"payment = '{v}'") + f" AS payment_{v}" for v in ("O", "P")) + " FROM c360")
def one_hot_drop_first(spark, sf):
    base = staged(customer360(spark, sf).select(R.key, "payment"), "c360")
    return rounded(prep.one_hot(base, ["payment"], prep.known_categories(base, ["payment"]), drop_first=True))


@query("one_hot_sparse", """WITH cells AS (SELECT doc_id, unnest([1, 2]) AS place, unnest([lang, source]) AS category FROM documents),
codes AS (SELECT place, category, row_number() OVER (ORDER BY place, category) - 1 AS slot FROM (SELECT DISTINCT place, category FROM cells WHERE category IS NOT NULL))
SELECT doc_id, (SELECT count(*) FROM codes)::BIGINT AS size, coalesce(string_agg(slot::VARCHAR, ',' ORDER BY slot), '') AS indices FROM cells LEFT JOIN codes USING (place, category) GROUP BY doc_id""")
def one_hot_sparse(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    codes = staged(prep.code_table(docs, ["lang", "source"]), "codes")
    found = prep.one_hot_sparse(docs, ["lang", "source"], codes)
    return rounded(found.select("doc_id", F.col("encoded.size").alias("size"), F.array_join(F.col("encoded.indices").cast("array<string>"), ",").alias("indices")))


@query("one_hot_long", """SELECT doc_id, 'lang' AS feature, lang AS category FROM documents WHERE lang IS NOT NULL
UNION ALL SELECT doc_id, 'source', source FROM documents WHERE source IS NOT NULL""")
def one_hot_long(spark, sf):
    return prep.one_hot_long(table(spark, sf, "documents"), "doc_id", ["lang", "source"])


@query("category_codes", """WITH seen AS (SELECT DISTINCT d.source FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
coded AS (SELECT source AS s, row_number() OVER (ORDER BY source) - 1 AS code FROM seen)
SELECT doc_id, coalesce(code, -1) AS source FROM documents LEFT JOIN coded ON source = s""")
def category_codes(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    marked = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return rounded(prep.with_codes(docs, prep.category_codes(marked, ["source"]), ["source"]))


@query("class_weights", with_(C360) + f"""SELECT {big('target')} AS target, count(*) AS n,
{r('(SELECT count(*) FROM c360) / (2 * count(*))::DOUBLE')} AS balanced,
{r('CASE WHEN target = 1 THEN ((SELECT count(*) FROM c360) - count(*)) / count(*)::DOUBLE ELSE 1 END')} AS pos_weight
FROM c360 GROUP BY target""")
def class_weights(spark, sf):
    base = staged(customer360(spark, sf).select("target"), "c360")
    return rounded(balance.class_weights(base, "target"))


def _vectors(spark, sf):
    """Embeddings with label 0 as the minority class."""
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), (F.col("label") == 0).cast("int").alias("y")
    )


_PAIRS = """v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings{0}),
d AS (SELECT a.vec_id AS k, b.vec_id AS o, a.y AS ya, b.y AS yb, list_distance(a.e, b.e) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id),
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dist, o) AS rank FROM d)"""


@query("knn_minority", with_(_PAIRS.format(" WHERE label = 0")) + f"""SELECT k AS vec_id, o AS neighbour, {r('dist')} AS distance,
rank FROM n WHERE rank <= 5""")
def knn_minority(spark, sf):
    return rounded(nearest_neighbours(_vectors(spark, sf).where("y = 1"), "vec_id", "vec", 5))


_SIGN = "CASE WHEN ('0x' || md5('42-' || t || '-' || j || '-' || i)[1])::INTEGER % 2 = 1 THEN 1 ELSE -1 END"
_BUCKETS = f"""v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
firsts AS (SELECT min(vec_id) AS id, e FROM v GROUP BY e),
shape AS (SELECT greatest(0, ceil(log2(count(*) / {buckets.BUCKET}.0)))::BIGINT AS cuts, max(len(e)) AS width FROM firsts),
signs AS (SELECT t, j, i, {_SIGN} AS s FROM shape, range({buckets.TABLES}) a(t), range(cuts + {buckets.MORE}) b(j), range(width) c(i)),
whole AS (SELECT id, unnest(range(len(e))) AS i, unnest(list_transform(e, lambda x : round(x * {buckets.UNIT})::BIGINT)) AS x FROM firsts),
sums AS (SELECT id, t, j, sum(s * x)::BIGINT AS place FROM whole JOIN signs USING (i) GROUP BY ALL),
cut AS (SELECT t, j, quantile_cont(place::DOUBLE, 0.5) AS m FROM sums, shape WHERE j < cuts GROUP BY t, j),
sides AS (SELECT id, t, j, place > m AS bit, row_number() OVER (PARTITION BY id, t ORDER BY abs(place - m), j) AS nearest FROM sums JOIN cut USING (t, j)),
coded AS (SELECT f.id, t, coalesce(sum(CASE WHEN bit THEN 1::BIGINT << j ELSE 0 END), 0)::BIGINT AS code FROM firsts f CROSS JOIN range({buckets.TABLES}) a(t) LEFT JOIN sides s USING (id, t) GROUP BY ALL),
tried AS (SELECT id, t, code FROM coded UNION ALL SELECT id, t, xor(code, 1::BIGINT << j) FROM coded JOIN sides USING (id, t) WHERE nearest <= {buckets.PROBES}),
cells AS (SELECT t, code, least({buckets.MORE}, greatest(0, ceil(log2(count(*) / {2 * buckets.BUCKET}.0)))) AS more FROM coded GROUP BY ALL),
means AS (SELECT t, code, j, sum(place)::DOUBLE / count(*) AS m FROM coded JOIN sums USING (id, t) JOIN cells USING (t, code), shape WHERE j >= cuts AND j < cuts + more GROUP BY ALL),
parts AS (SELECT id, t, code, s.j - cuts AS j, place > m AS bit, row_number() OVER (PARTITION BY id, t, code ORDER BY abs(place - m), s.j) AS nearest
FROM tried JOIN means USING (t, code) JOIN sums s USING (id, t, j), shape),
own AS (SELECT x.id, x.t, x.code, coalesce(sum(CASE WHEN bit THEN 1::BIGINT << j ELSE 0 END), 0)::BIGINT AS part FROM tried x LEFT JOIN parts p USING (id, t, code) GROUP BY ALL),
asked AS (SELECT * FROM own UNION ALL SELECT id, t, code, xor(part, 1::BIGINT << j) FROM own JOIN parts USING (id, t, code) WHERE nearest <= {buckets.MORE_PROBES}),
met AS (SELECT DISTINCT a.id AS a, b.id AS b FROM asked a JOIN (own JOIN coded USING (id, t, code)) b ON a.t = b.t AND a.code = b.code AND a.part = b.part AND a.id <> b.id),
rows_met AS (SELECT x.vec_id AS k, y.vec_id AS o, list_distance(p.e, q.e) AS dist FROM met JOIN firsts p ON p.id = a JOIN firsts q ON q.id = b JOIN v x ON x.e = p.e JOIN v y ON y.e = q.e
UNION ALL SELECT x.vec_id, y.vec_id, 0e0 FROM v x JOIN v y ON x.e = y.e AND x.vec_id <> y.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dist, o) AS rank FROM rows_met)"""


@query("knn_bucketed", with_(_BUCKETS) + f"""SELECT k AS vec_id, o AS neighbour, {r('dist')} AS distance, rank FROM ranked WHERE rank <= 5""")
def knn_bucketed(spark, sf):
    """Five near rows of every vector from hash tables, the same tables in SQL."""
    return rounded(bucketed_neighbours(_vectors(spark, sf), "vec_id", "vec", 5))


@query("tomek_links", with_(_PAIRS.format("")) + """SELECT a.k AS low_key, a.o AS high_key FROM n a JOIN n b
ON a.k = b.o AND a.o = b.k WHERE a.rank = 1 AND b.rank = 1 AND a.ya <> a.yb AND a.k < a.o""")
def tomek_links(spark, sf):
    return balance.tomek_links(_vectors(spark, sf), "vec_id", "vec", "y")


@query("tomek_clean", with_(_PAIRS.format("")) + f"""SELECT vec_id, {big('y')} AS y FROM v WHERE vec_id NOT IN (
SELECT a.k FROM n a JOIN n b ON a.k = b.o AND a.o = b.k WHERE a.rank = 1 AND b.rank = 1 AND a.ya <> a.yb)""")
def tomek_clean(spark, sf):
    return rounded(balance.drop_tomek(_vectors(spark, sf), "vec_id", "vec", "y").select("vec_id", "y"))


@query("smote_balance", f"""WITH v AS (SELECT CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings),
c AS (SELECT y, count(*) AS n FROM v GROUP BY 1)
SELECT {big('y')} AS y, n AS before, (SELECT max(n) FROM c) AS after FROM c""")
def smote_balance(spark, sf):
    rows = _vectors(spark, sf)
    made = balance.smote(rows, "vec_id", "vec", "y").groupBy("y").agg(F.count("*").alias("added"))
    counts = rows.groupBy("y").agg(F.count("*").alias("before"))
    return rounded(
        counts.join(made, "y", "left").select(
            "y", "before", (F.col("before") + F.coalesce("added", F.lit(0))).alias("after")
        )
    )


def _hex(digits: str) -> str:
    return f"CAST('0x' || {digits} AS BIGINT)"


_MADE = _PAIRS.format(" WHERE label = 0") + f""", sizes AS (SELECT count(*) FILTER (label = 0) AS small,
count(*) FILTER (label <> 0) - count(*) FILTER (label = 0) AS missing FROM embeddings),
ordered AS (SELECT vec_id, e, row_number() OVER (ORDER BY md5(concat(vec_id, '-42'))) AS place FROM v),
copies AS (SELECT vec_id, e, c AS copy, md5(concat(vec_id, '-', c, '-42')) AS h FROM ordered, sizes,
range(1, CAST(missing // small + CASE WHEN place <= missing % small THEN 1 ELSE 0 END + 1 AS BIGINT)) t(c)),
near AS (SELECT k, list(o ORDER BY rank) AS mates FROM n WHERE rank <= 5 GROUP BY k),
picked AS (SELECT vec_id AS parent, e, copy, mates[CAST({_hex('substr(h, 1, 8)')} % len(mates) + 1 AS BIGINT)] AS neighbour,
{_hex('substr(h, 9, 12)')} / {1 << 48}::DOUBLE AS gap FROM copies JOIN near ON vec_id = k),
made AS (SELECT parent, neighbour, gap, copy, list_transform(range(1, len(p.e) + 1), lambda i : p.e[i] + (q.e[i] - p.e[i]) * gap) AS vec
FROM picked p JOIN v q ON neighbour = vec_id)"""


@query("smote", with_(_MADE) + f"""SELECT parent, neighbour, {r('gap')} AS gap, {big('copy')} AS copy, {r('vec[1]')} AS first,
{r('list_sum(vec)')} AS total, CAST(1 AS BIGINT) AS y FROM made""")
def smote(spark, sf):
    made = balance.smote(_vectors(spark, sf), "vec_id", "vec", "y")
    total = F.aggregate("vec", F.lit(0.0), lambda a, b: a + b)
    return rounded(made.select("parent", "neighbour", "gap", "copy", F.get("vec", F.lit(0)).alias("first"), total.alias("total"), "y"))


_BOTH = _MADE + """, both_kinds AS (SELECT CAST(vec_id AS VARCHAR) AS vec_id, CAST(embedding AS DOUBLE[]) AS e,
CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings UNION ALL SELECT concat(parent, '~', copy), vec, 1 FROM made),
d2 AS (SELECT a.vec_id AS k, b.vec_id AS o, a.y AS ya, b.y AS yb, list_distance(a.e, b.e) AS dist
FROM both_kinds a JOIN both_kinds b ON a.vec_id <> b.vec_id),
n2 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dist, o) AS rank FROM d2)"""


@query("smote_tomek", with_(_BOTH) + f"""SELECT vec_id, {big('y')} AS y, {r('list_sum(e)')} AS total FROM both_kinds WHERE vec_id NOT IN (
SELECT a.k FROM n2 a JOIN n2 b ON a.k = b.o AND a.o = b.k WHERE a.rank = 1 AND b.rank = 1 AND a.ya <> a.yb)""")
def smote_tomek(spark, sf):
    rows = balance.smote_tomek(_vectors(spark, sf), "vec_id", "vec", "y")
    return rounded(rows.select("vec_id", "y", F.aggregate("vec", F.lit(0.0), lambda a, b: a + b).alias("total")))
