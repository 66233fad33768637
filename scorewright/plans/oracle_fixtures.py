"""DuckDB SQL twins of the fixture views, written independently of the Spark code.

Each oracle query is ``WITH <fixture CTEs> <body>``.  DuckDB specifics: literals
like ``0.1`` are DECIMAL (written ``0.1::DOUBLE``), ``sum(int)`` is HUGEINT (cast
to BIGINT), no ``log1p`` (``ln(1 + x)``), ``x/0`` is ``inf`` (guarded with CASE).
"""

from __future__ import annotations

_CTES = {
    "_acc_orders": """
_acc_orders AS (
  SELECT o_custkey AS cust,
         count(*) AS n_orders,
         sum(o_totalprice) AS price_sum,
         count_if(o_orderstatus = 'F') AS n_done,
         min(datediff('day', DATE '1995-01-01', o_orderdate::DATE)) AS d_first,
         max(datediff('day', DATE '1995-01-01', o_orderdate::DATE)) AS d_last,
         min(CASE WHEN o_orderstatus = 'F' THEN datediff('day', DATE '1995-01-01', o_orderdate::DATE) END) AS d_first_done,
         max(CASE WHEN o_orderstatus = 'F' THEN datediff('day', DATE '1995-01-01', o_orderdate::DATE) END) AS d_last_done,
         max(o_totalprice) AS price_max,
         min(o_totalprice) AS price_min,
         count_if(substr(o_orderpriority, 1, 1) = '1') AS n_p1,
         count_if(substr(o_orderpriority, 1, 1) = '2') AS n_p2,
         count_if(substr(o_orderpriority, 1, 1) = '3') AS n_p3,
         count_if(substr(o_orderpriority, 1, 1) = '4') AS n_p4
  FROM orders GROUP BY o_custkey)""",
    "_acc_lines": """
_acc_lines AS (
  SELECT o.o_custkey AS cust,
         count(*)::BIGINT AS n_lines,
         count_if(l.l_returnflag = 'R')::BIGINT AS n_returned,
         count(DISTINCT l.l_orderkey)::BIGINT AS n_orders_lined,
         count(DISTINCT l.l_suppkey)::BIGINT AS n_suppliers
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey)""",
    "_acc0": """
_acc0 AS (
  SELECT c.c_custkey AS id,
         a.d_first / 365.25::DOUBLE AS age_first_funding_year,
         a.d_last / 365.25::DOUBLE AS age_last_funding_year,
         a.d_first_done / 365.25::DOUBLE AS age_first_milestone_year,
         a.d_last_done / 365.25::DOUBLE AS age_last_milestone_year,
         CAST(li.n_suppliers AS INTEGER) AS relationships,
         CAST(a.n_orders AS INTEGER) AS funding_rounds,
         CAST(round(a.price_sum) AS BIGINT) AS funding_total_usd,
         CAST(a.n_done AS INTEGER) AS milestones,
         CAST(coalesce(r.r_name = 'AMERICA', false) AS INTEGER) AS is_CA,
         CAST(coalesce(r.r_name = 'EUROPE', false) AS INTEGER) AS is_NY,
         CAST(coalesce(r.r_name = 'ASIA', false) AS INTEGER) AS is_MA,
         CAST(coalesce(r.r_name = 'AFRICA', false) AS INTEGER) AS is_TX,
         CAST(coalesce(r.r_name = 'MIDDLE EAST', false) AS INTEGER) AS is_otherstate,
         c.c_mktsegment || '_' || CAST(c.c_custkey % 7 AS VARCHAR) AS category_code,
         (CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
            WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 ELSE -1 END) * 2 + c.c_custkey % 2 AS sector_ix,
         CAST(coalesce(a.price_max > 480000, false) AS INTEGER) AS has_VC,
         CAST(coalesce(a.price_min < 15000, false) AS INTEGER) AS has_angel,
         CAST(coalesce(a.n_p1 >= 2, false) AS INTEGER) AS has_roundA,
         CAST(coalesce(a.n_p2 >= 3, false) AS INTEGER) AS has_roundB,
         CAST(coalesce(a.n_p3 >= 4, false) AS INTEGER) AS has_roundC,
         CAST(coalesce(a.n_p4 >= 5, false) AS INTEGER) AS has_roundD,
         CASE WHEN li.n_orders_lined > 0 THEN li.n_lines::DOUBLE / li.n_orders_lined END AS avg_participants,
         CAST(coalesce(li.n_returned * 3 < li.n_lines, false) AS INTEGER) AS labels
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN _acc_orders a ON c.c_custkey = a.cust
  LEFT JOIN _acc_lines li ON c.c_custkey = li.cust)""",
    "account": """
account AS (
  SELECT id, age_first_funding_year, age_last_funding_year, age_first_milestone_year,
         age_last_milestone_year, relationships, funding_rounds, funding_total_usd, milestones,
         is_CA, is_NY, is_MA, is_TX, is_otherstate, category_code,
         CAST(sector_ix = 0 AS INTEGER) AS is_software, CAST(sector_ix = 1 AS INTEGER) AS is_web,
         CAST(sector_ix = 2 AS INTEGER) AS is_mobile, CAST(sector_ix = 3 AS INTEGER) AS is_enterprise,
         CAST(sector_ix = 4 AS INTEGER) AS is_advertising, CAST(sector_ix = 5 AS INTEGER) AS is_gamesvideo,
         CAST(sector_ix = 6 AS INTEGER) AS is_ecommerce, CAST(sector_ix = 7 AS INTEGER) AS is_biotech,
         CAST(sector_ix = 8 AS INTEGER) AS is_consulting, CAST(sector_ix = 9 AS INTEGER) AS is_othercategory,
         has_VC, has_angel, has_roundA, has_roundB, has_roundC, has_roundD, avg_participants, labels,
         CAST(coalesce(funding_rounds + 2 * milestones >
              (SELECT median(funding_rounds + 2 * milestones) FROM _acc0), false) AS INTEGER) AS labels_planted
  FROM _acc0)""",
    "scored": """
scored AS (
  SELECT id, labels AS label,
         least(coalesce(relationships, 0) + coalesce(milestones, 0) * 4
               + (is_CA + is_NY + is_MA) * 10 + id % 10, 99)::DOUBLE / 100.0::DOUBLE AS score
  FROM account)""",
    "account_split": """
account_split AS (
  SELECT * EXCLUDE (rn, n), CAST(rn <= round(0.2::DOUBLE * n) AS INTEGER) AS is_test,
         CAST((rn - 1) % 5 AS INTEGER) AS fold
  FROM (SELECT *, row_number() OVER (PARTITION BY labels ORDER BY substr(md5(CAST(id AS VARCHAR) || '|42'), 1, 15), id) AS rn,
               count(*) OVER (PARTITION BY labels) AS n FROM account))""",
    "train": """
train AS (SELECT * EXCLUDE (is_test, fold) FROM account_split WHERE is_test = 0)""",
    "vsplit": """
vsplit AS (
  SELECT vec_id, embedding, y, CAST(rn <= round(0.2::DOUBLE * n) AS INTEGER) AS is_test
  FROM (SELECT vec_id, embedding, CAST(label = 0 AS INTEGER) AS y,
               row_number() OVER (PARTITION BY CAST(label = 0 AS INTEGER)
                                  ORDER BY substr(md5(CAST(vec_id AS VARCHAR) || '|42'), 1, 15), vec_id) AS rn,
               count(*) OVER (PARTITION BY CAST(label = 0 AS INTEGER)) AS n FROM embeddings))""",
    "doc_quality": """
doc_quality AS (
  SELECT d.doc_id, d.n_chars, d.lang, d.source, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)""",
}

_DEPS = {
    "_acc0": ["_acc_orders", "_acc_lines"],
    "account": ["_acc0"],
    "scored": ["account"],
    "account_split": ["account"],
    "train": ["account_split"],
}


def _closure(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return order


def with_fixtures(body: str, *fixtures: str, extra: str | None = None) -> str:
    """``WITH <fixture CTEs>[, extra CTEs] <body>``."""
    parts = [_CTES[n].strip().replace(" AS (", " AS MATERIALIZED (", 1) for n in _closure(fixtures)]
    if extra:
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
