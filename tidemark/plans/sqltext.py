"""SQL text shared by the reference statements the queries are checked against."""

from __future__ import annotations

from collections.abc import Sequence


def r(expr: str, digits: int = 6) -> str:
    """Rounded double with -0.0 folded into 0.0."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0e0)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def long(columns: Sequence[str], source: str, ids: str = "", kind: str = "DOUBLE") -> str:
    """(ids, feature, value): one row per cell."""
    lead = f"{ids}, " if ids else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, CAST({c} AS {kind}) AS value FROM {source}" for c in columns
    )


def quantile(array: str, q: float) -> str:
    """Linear-interpolated quantile of a sorted list."""
    h = f"((len({array}) - 1) * {q!r}::DOUBLE)"
    low, high = (f"{array}[CAST({f}({h}) AS BIGINT) + 1]" for f in ("floor", "ceil"))
    return f"({low} + ({high} - {low}) * ({h} - floor({h})))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _yes(condition: str, name: str) -> str:
    return f"CASE WHEN max(CASE WHEN past AND {condition} THEN 1 ELSE 0 END) = 1 THEN 'Yes' ELSE 'No' END AS {name}"


C360 = f"""
cut AS (SELECT max(o_orderdate) - INTERVAL 365 DAY AS t FROM orders),
returned AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
past_orders AS (
  SELECT o.*, o_orderdate <= (SELECT t FROM cut) AS past, l_orderkey IS NOT NULL AS ret,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amt
  FROM orders o LEFT JOIN returned ON o_orderkey = l_orderkey),
latest AS (
  SELECT o_custkey AS ck, o_orderstatus AS payment
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM past_orders WHERE past) WHERE rn = 1),
history AS (
  SELECT o_custkey, 1 - max(CASE WHEN past THEN 0 ELSE 1 END) AS target,
         min(CASE WHEN past THEN o_orderdate END) AS first_date,
         max(CASE WHEN past THEN o_orderdate END) AS last_date,
         count(CASE WHEN past THEN 1 END) AS n,
         sum(CASE WHEN past THEN amt END) AS amount,
         {_yes("ret", "paperless")},
         {_yes("o_orderpriority = '1-URGENT'", "svc_urgent")},
         {_yes("o_orderpriority = '2-HIGH'", "svc_high")},
         {_yes("o_orderpriority = '3-MEDIUM'", "svc_medium")},
         {_yes("o_orderpriority = '4-NOT SPECIFIED'", "svc_unspecified")},
         {_yes("o_orderpriority = '5-LOW'", "svc_low")}
  FROM past_orders GROUP BY o_custkey),
c360 AS (
  SELECT c_custkey AS customer_key, target,
         CAST(date_diff('day', first_date, (SELECT t FROM cut)) // 30 AS INTEGER) AS tenure,
         CAST(date_diff('day', last_date, (SELECT t FROM cut)) // 30 AS INTEGER) AS recency,
         CAST(amount AS DOUBLE) / n AS monthly,
         CAST(amount AS DOUBLE) AS total,
         CASE WHEN c_acctbal < 0 THEN ' ' ELSE CAST(amount AS VARCHAR) END AS total_text,
         c_acctbal AS balance, c_mktsegment AS contract, r_name AS internet, payment, paperless,
         CASE WHEN c_nationkey % 2 = 1 THEN 'Yes' ELSE 'No' END AS partner,
         CASE WHEN c_acctbal > 0 THEN 'Yes' ELSE 'No' END AS dependents,
         CASE WHEN c_nationkey >= 20 THEN 1 ELSE 0 END AS senior,
         svc_urgent, svc_high, svc_medium, svc_unspecified, svc_low
  FROM history JOIN latest ON o_custkey = ck JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
  WHERE n > 0)
"""
