from __future__ import annotations

from tallyline.oracles.parts import with_ctes

PURCHASES = """
purchases AS (
  SELECT o_custkey AS customer_id, l_partkey AS product_id, CAST(o_orderdate AS DATE) AS bought_on,
         l_orderkey AS ok, l_linenumber AS ln, p_type AS kind,
         CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18,2)) AS amount
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey)
"""

MEMBERS = """
club AS (
  SELECT c_custkey AS member_id, DATE '1997-01-01' + CAST(c_custkey % 730 AS INTEGER) AS joined_on
  FROM customer WHERE c_custkey % 3 <> 0)
"""

MEMBER_PURCHASES = """
member_purchases AS (SELECT * FROM purchases JOIN club ON member_id = customer_id)
"""


def _over(query: str, *ctes: str) -> str:
    return with_ctes(PURCHASES, *ctes, query=query)


SQL = {
    "spend_per_customer": _over(
        "SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS total_spend FROM purchases GROUP BY customer_id"
    ),
    "visit_days_per_customer": _over(
        "SELECT customer_id, count(DISTINCT bought_on) AS visit_days FROM purchases GROUP BY customer_id"
    ),
    "first_item_per_customer": _over("""
        SELECT DISTINCT ON (customer_id) customer_id, product_id, bought_on AS order_date
        FROM purchases ORDER BY customer_id, bought_on, ok, ln, product_id"""),
    "most_purchased_item": """
        SELECT l_partkey AS product_id, count(*) AS n_purchases FROM lineitem
        GROUP BY l_partkey ORDER BY n_purchases DESC, product_id LIMIT 1""",
    "favourite_item_per_customer": _over("""
        SELECT customer_id, product_id, n_purchases FROM (
          SELECT customer_id, product_id, count(*) AS n_purchases,
                 row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_id) AS place
          FROM purchases GROUP BY customer_id, product_id) WHERE place = 1"""),
    "first_item_after_joining": _over(
        """
        SELECT DISTINCT ON (customer_id) customer_id, product_id, bought_on AS order_date
        FROM member_purchases WHERE bought_on >= joined_on
        ORDER BY customer_id, bought_on, ok, ln, product_id""",
        MEMBERS,
        MEMBER_PURCHASES,
    ),
    "last_item_before_joining": _over(
        """
        SELECT DISTINCT ON (customer_id) customer_id, product_id, bought_on AS order_date
        FROM member_purchases WHERE bought_on < joined_on
        ORDER BY customer_id, bought_on DESC, ok DESC, ln DESC, product_id DESC""",
        MEMBERS,
        MEMBER_PURCHASES,
    ),
    "premember_items_and_spend": _over(
        """
        SELECT customer_id, count(DISTINCT product_id) AS n_items, CAST(sum(amount) AS DOUBLE) AS amount_spent
        FROM member_purchases WHERE bought_on - joined_on < 0 GROUP BY customer_id""",
        MEMBERS,
        MEMBER_PURCHASES,
    ),
    "loyalty_points_by_item_weight": _over("""
        SELECT customer_id,
               CAST(10 * sum(CASE kind WHEN 'PROMO' THEN 2 * amount ELSE amount END) AS DOUBLE) AS points
        FROM purchases GROUP BY customer_id"""),
    "loyalty_points_with_join_bonus": _over(
        """
        SELECT customer_id,
               CAST(10 * sum(amount * CASE WHEN bought_on < joined_on + 7 OR kind = 'PROMO' THEN 2 ELSE 1 END)
                    AS DOUBLE) AS points
        FROM member_purchases
        WHERE bought_on >= joined_on AND bought_on < DATE '1999-01-01'
        GROUP BY customer_id""",
        MEMBERS,
        MEMBER_PURCHASES,
    ),
}
