from __future__ import annotations

from tallyline.oracles.parts import half_up, with_ctes

BASKETS = """
priced AS (
  SELECT l_orderkey AS txn, l_partkey AS product,
         CAST(l_quantity AS INTEGER) * CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS gross_cents,
         CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS INTEGER) AS pct
  FROM lineitem JOIN part ON p_partkey = l_partkey),
per_txn AS (
  SELECT txn, count(DISTINCT product) AS n_products, o_custkey % 3 <> 0 AS is_member,
         CAST(sum(gross_cents * (100 - pct)) AS HUGEINT) AS revenue_e4,
         CAST(sum(gross_cents * pct) AS HUGEINT) AS discount_e4
  FROM priced LEFT JOIN orders ON o_orderkey = txn GROUP BY txn, o_custkey)
"""

SIZE = f"count(*) AS n_transactions, {half_up('sum(n_products)', 'count(*)', 4)} AS avg_products"
PERCENTILES = ", ".join(
    f"CAST(percentile_disc({p}) WITHIN GROUP (ORDER BY revenue_e4) AS DOUBLE) / 10000 AS {name}"
    for name, p in (("revenue_p25", 0.25), ("revenue_p50", 0.5), ("revenue_p75", 0.75))
)
DISCOUNT = f"{half_up('sum(discount_e4)', '10000 * count(*)', 2)} AS avg_discount"
SHARE = f"{half_up('100 * count(*) FILTER (WHERE is_member)', 'count(*)', 2)} AS member_pct"


def _mean_revenue(condition: str, alias: str) -> str:
    total = f"sum(revenue_e4) FILTER (WHERE {condition})"
    return f"{half_up(total, f'10000 * count(*) FILTER (WHERE {condition})', 2)} AS {alias}"


def _report(*columns: str) -> str:
    return with_ctes(BASKETS, query=f"SELECT {', '.join(columns)} FROM per_txn")


SQL = {
    "monthly_product_revenue": """
        SELECT strftime(l_shipdate, '%Y-%m') AS month, l_partkey AS prod_id,
               CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS qty,
               CAST(sum(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
               CAST(sum(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18,2))
                        * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS discount
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""",
    "unique_transactions": "SELECT count(DISTINCT l_orderkey) AS n_transactions FROM lineitem",
    "avg_products_per_transaction": with_ctes(
        "sizes AS (SELECT count(DISTINCT l_partkey) AS n_products FROM lineitem GROUP BY l_orderkey)",
        query=f"SELECT {SIZE} FROM sizes",
    ),
    "revenue_percentiles": _report(SIZE, PERCENTILES),
    "avg_discount_per_transaction": _report(SIZE, PERCENTILES, DISCOUNT),
    "member_transaction_share": _report(SIZE, PERCENTILES, DISCOUNT, SHARE),
    "member_vs_nonmember_revenue": _report(
        SIZE,
        PERCENTILES,
        DISCOUNT,
        SHARE,
        _mean_revenue("is_member", "avg_member_revenue"),
        _mean_revenue("NOT is_member", "avg_nonmember_revenue"),
    ),
}
