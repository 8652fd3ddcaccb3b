from __future__ import annotations

from tallyline.oracles.parts import half_up, with_ctes

# The deliveries as the numbers they were rendered from; the cleaning must bring these back.
DELIVERIES = """
runs AS (
  SELECT o_orderkey AS ok, o_custkey AS customer_id, o_custkey % 10 AS runner_id,
         o_orderkey % 4 = 3 AS cancelled,
         CAST(o_orderdate AS TIMESTAMP) + to_minutes((o_orderkey * 37) % 1440) AS placed,
         60 * ((o_orderkey * 13) % 50 + 10) + o_orderkey % 60 AS wait_s,
         o_orderkey % 250 + 10 AS tenths, o_orderkey % 31 + 10 AS mins
  FROM orders)
"""

LINES = """
order_items AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS product_id,
         CASE l_partkey % 5
           WHEN 3 THEN CAST(l_partkey % 12 + 1 AS VARCHAR)
           WHEN 4 THEN concat(l_partkey % 12 + 1, ', ', (l_partkey + 5) % 12 + 1) END AS removed,
         CASE l_suppkey % 6
           WHEN 3 THEN CAST(l_suppkey % 12 + 1 AS VARCHAR)
           WHEN 4 THEN concat(l_suppkey % 12 + 1, ', ', (l_suppkey + 4) % 12 + 1)
           WHEN 5 THEN concat(l_suppkey % 12 + 1, ', ', (l_suppkey + 4) % 12 + 1, ', ', (l_suppkey + 7) % 12 + 1)
         END AS added
  FROM lineitem)
"""

NAMED_LINES = """
named_items AS (SELECT oi.*, p_type AS item FROM order_items oi LEFT JOIN part ON p_partkey = product_id)
"""

DELIVERED = """
delivered AS (SELECT * FROM order_items JOIN runs USING (ok) WHERE NOT cancelled)
"""

ORDER_SIZES = """
sizes AS (
  SELECT ok, count(*) AS n_lines, count(DISTINCT product_id) AS n_products FROM order_items GROUP BY ok)
"""

SIZED = "sized AS (SELECT * FROM sizes JOIN runs USING (ok))"

INGREDIENTS = """
pantry(ingredient_id, ingredient) AS (VALUES
  (1, 'Basil'), (2, 'Walnut'), (3, 'Olive'), (4, 'Feta'), (5, 'Chickpea'), (6, 'Aubergine'),
  (7, 'Rice'), (8, 'Sumac'), (9, 'Lentil'), (10, 'Cress'), (11, 'Tahini'), (12, 'Paprika'))
"""

RECIPES = """
recipe_parts AS (
  SELECT DISTINCT p_type AS item, i AS ingredient_id
  FROM part, range(1, 13) r(i)
  WHERE (ascii(p_type) * i + length(p_type)) % 3 <> 0)
"""

RECIPE_TEXT = """
recipe_text AS (
  SELECT item AS recipe_item, string_agg(CAST(ingredient_id AS VARCHAR), ', ' ORDER BY ingredient_id) AS recipe
  FROM recipe_parts GROUP BY item)
"""

TALLY = """
entries AS (
  SELECT ok, item, ingredient_id, 1 AS sign FROM named_items JOIN recipe_parts USING (item)
  UNION ALL
  SELECT ok, item, CAST(trim(unnest(string_split(removed, ','))) AS INTEGER), -1 FROM named_items
  UNION ALL
  SELECT ok, item, CAST(trim(unnest(string_split(added, ','))) AS INTEGER), 1 FROM named_items)
"""

MINUTES = half_up("wait_s", "60", 2)


def _lookup(column: str) -> str:
    """The names behind a list column, in list order."""
    return f"""(SELECT string_agg(ingredient, ', ' ORDER BY nth)
      FROM (SELECT unnest(string_split({column}, ',')) AS one, generate_subscripts(string_split({column}, ','), 1) AS nth)
      JOIN pantry ON ingredient_id = CAST(trim(one) AS INTEGER))"""


def _frequency(column: str) -> str:
    return with_ctes(
        LINES,
        query=f"""
        SELECT CAST(trim(one) AS BIGINT) AS ingredient_id, count(*) AS n_times
        FROM (SELECT unnest(string_split({column}, ',')) AS one FROM order_items)
        GROUP BY ALL""",
    )


SQL = {
    "clean_null_sentinels": with_ctes(
        DELIVERIES,
        query="""
        SELECT ok AS order_id,
               CASE WHEN NOT cancelled THEN strftime(placed + to_seconds(wait_s), '%Y-%m-%d %H:%M:%S') END AS pickup_time,
               CASE ok % 4 WHEN 0 THEN concat(CAST(tenths / 10 AS DECIMAL(10,1)), 'km')
                           WHEN 1 THEN concat(CAST(tenths / 10 AS DECIMAL(10,1)), ' km')
                           WHEN 2 THEN CAST(CAST(tenths / 10 AS DECIMAL(10,1)) AS VARCHAR) END AS distance,
               CASE ok % 4 WHEN 0 THEN concat(mins, ' minutes') WHEN 1 THEN concat(mins, 'mins')
                           WHEN 2 THEN concat(mins, ' minute') END AS duration,
               CASE WHEN cancelled THEN 'Cancelled' END AS cancellation
        FROM runs""",
    ),
    "clean_null_sentinels_in_lists": with_ctes(
        LINES,
        query="SELECT ok AS order_id, CAST(ln AS BIGINT) AS line_number, product_id, removed, added FROM order_items",
    ),
    "clean_distance_numeric": with_ctes(
        DELIVERIES,
        query="SELECT ok AS order_id, CASE WHEN NOT cancelled THEN CAST(tenths AS DOUBLE) / 10 END AS distance FROM runs",
    ),
    "clean_duration_numeric": with_ctes(
        DELIVERIES,
        query="SELECT ok AS order_id, CASE WHEN NOT cancelled THEN CAST(mins AS DOUBLE) END AS duration FROM runs",
    ),
    "ordered_item_count": "SELECT count(l_partkey) AS n_items FROM lineitem",
    "unique_order_configs": with_ctes(
        LINES,
        NAMED_LINES,
        query="SELECT count(*) AS n_configs FROM (SELECT DISTINCT item, removed, added FROM named_items)",
    ),
    "successful_per_runner": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query="""
        SELECT runner_id, count(*) AS n_lines, count(DISTINCT ok) AS n_orders FROM delivered GROUP BY runner_id""",
    ),
    "delivered_per_item_type": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query="""
        SELECT p_type AS item, count(*) AS n_delivered FROM delivered JOIN part ON p_partkey = product_id
        GROUP BY p_type""",
    ),
    "item_mix_per_customer": """
        SELECT o_custkey AS customer_id, p_type AS item, count(*) AS n_items
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        GROUP BY ALL""",
    "max_items_in_order": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query="""
        SELECT ok AS order_id, count(*) AS n_lines FROM delivered GROUP BY ok
        ORDER BY n_lines DESC, order_id LIMIT 1""",
    ),
    "changed_vs_unchanged": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query="""
        SELECT customer_id, CASE WHEN removed IS NULL AND added IS NULL THEN '0' ELSE '1' END AS changed,
               count(*) AS n_items
        FROM delivered GROUP BY ALL""",
    ),
    "both_removed_and_added": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query="SELECT count(*) AS n_items FROM delivered WHERE removed IS NOT NULL AND added IS NOT NULL",
    ),
    "volume_by_hour": with_ctes(
        LINES,
        DELIVERIES,
        query="""
        SELECT CAST(hour(placed) AS BIGINT) AS order_hour, count(*) AS n_items
        FROM order_items JOIN runs USING (ok) GROUP BY ALL""",
    ),
    "volume_by_weekday": with_ctes(
        LINES,
        DELIVERIES,
        query="SELECT dayname(placed) AS weekday, count(*) AS n_items FROM order_items JOIN runs USING (ok) GROUP BY ALL",
    ),
    "pickup_minutes_per_order": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query=f"SELECT DISTINCT ok AS order_id, {MINUTES} AS minutes FROM delivered",
    ),
    "prep_time_correlation": with_ctes(
        LINES,
        DELIVERIES,
        ORDER_SIZES,
        SIZED,
        query=f"SELECT round(corr({MINUTES}, n_lines), 6) AS correlation FROM sized WHERE NOT cancelled",
    ),
    "mean_distance_per_order": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query=f"""
        SELECT ok AS order_id, customer_id, {half_up('sum(tenths)', '10 * count(*)', 2)} AS mean_distance
        FROM delivered GROUP BY ok, customer_id""",
    ),
    "delivery_time_spread": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query=f"""
        SELECT CAST(max(CAST({MINUTES} AS DECIMAL(18,2))) - min(CAST({MINUTES} AS DECIMAL(18,2))) AS DOUBLE)
               AS spread_minutes FROM delivered""",
    ),
    "speed_per_delivery": with_ctes(
        LINES,
        DELIVERIES,
        DELIVERED,
        query=f"""
        SELECT DISTINCT placed AS order_time, ok AS order_id, runner_id, {half_up('tenths', '10 * mins', 4)} AS speed
        FROM delivered""",
    ),
    "cancellation_rate_per_runner": with_ctes(
        DELIVERIES,
        query=f"""
        SELECT runner_id, count(*) AS n_orders,
               {half_up('100 * count(*) FILTER (WHERE cancelled)', 'count(*)', 2)} AS cancelled_pct,
               {half_up('100 * count(*) FILTER (WHERE NOT cancelled)', 'count(*)', 2)} AS success_pct
        FROM runs GROUP BY runner_id""",
    ),
    "fixed_price_revenue": """
        SELECT CAST(sum(CASE WHEN p_type = 'PROMO' THEN 12 ELSE 10 END) AS BIGINT) AS revenue
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "delivery_report": with_ctes(
        LINES,
        DELIVERIES,
        ORDER_SIZES,
        SIZED,
        query=f"""
        SELECT ok AS order_id, customer_id, runner_id, ok * 7 % 5 + 1 AS rating, placed AS order_time,
               placed + to_seconds(wait_s) AS pickup_time, {MINUTES} AS minutes_to_pickup,
               CAST(mins AS DOUBLE) AS duration, {half_up('tenths', '10 * mins', 2)} AS speed, n_lines, n_products
        FROM sized WHERE NOT cancelled""",
    ),
    "net_revenue_after_payout": with_ctes(
        LINES,
        DELIVERIES,
        NAMED_LINES,
        query="""
        SELECT CAST(sum(sales - CAST(tenths AS DECIMAL(18,1)) / 10 * 0.3) AS DECIMAL(18,2))::DOUBLE AS net_revenue
        FROM (SELECT ok, sum(CASE WHEN item = 'PROMO' THEN 12 ELSE 10 END) AS sales FROM named_items GROUP BY ok)
        JOIN runs USING (ok) WHERE NOT cancelled""",
    ),
    "ingredients_per_item": with_ctes(
        INGREDIENTS,
        RECIPES,
        query="""
        SELECT item, string_agg(ingredient, ', ' ORDER BY ingredient) AS ingredients
        FROM recipe_parts JOIN pantry USING (ingredient_id) GROUP BY item""",
    ),
    "added_frequency": _frequency("added"),
    "removed_frequency": _frequency("removed"),
    "paired_changes": with_ctes(
        INGREDIENTS,
        LINES,
        query="""
        SELECT r.ingredient AS removed_ingredient, a.ingredient AS added_ingredient, count(*) AS n_lines
        FROM (SELECT unnest(string_split(removed, ',')) AS off, unnest(string_split(added, ',')) AS extra
              FROM order_items) AS lockstep
        LEFT JOIN pantry r ON r.ingredient_id = CAST(trim(off) AS INTEGER)
        LEFT JOIN pantry a ON a.ingredient_id = CAST(trim(extra) AS INTEGER)
        GROUP BY ALL""",
    ),
    "distinct_changes": with_ctes(LINES, NAMED_LINES, query="SELECT DISTINCT item, removed, added FROM named_items"),
    "order_item_label": with_ctes(
        INGREDIENTS,
        LINES,
        NAMED_LINES,
        DELIVERIES,
        f"off_names AS (SELECT removed, {_lookup('removed')} AS names FROM (SELECT DISTINCT removed FROM order_items))",
        f"extra_names AS (SELECT added, {_lookup('added')} AS names FROM (SELECT DISTINCT added FROM order_items))",
        query="""
        SELECT ok AS order_id, customer_id, placed AS order_time,
               item || coalesce(' - Exclude ' || o.names, '') || coalesce(' - Extra ' || e.names, '') AS label
        FROM named_items JOIN runs USING (ok)
        LEFT JOIN off_names o USING (removed) LEFT JOIN extra_names e USING (added)""",
    ),
    "order_ingredient_list": with_ctes(
        INGREDIENTS,
        LINES,
        NAMED_LINES,
        RECIPES,
        TALLY,
        query="""
        SELECT ok AS order_id, item,
               item || ': ' || string_agg(CASE WHEN net > 1 THEN net || 'x' ELSE '' END || ingredient, ', '
                                          ORDER BY ingredient) AS ingredient_list
        FROM (SELECT ok, item, ingredient_id, CAST(sum(sign) AS BIGINT) AS net FROM entries GROUP BY ALL)
        JOIN pantry USING (ingredient_id) WHERE net > 0 GROUP BY ok, item""",
    ),
    "ingredient_usage_total": with_ctes(
        INGREDIENTS,
        LINES,
        NAMED_LINES,
        DELIVERIES,
        RECIPES,
        TALLY,
        query="""
        SELECT ingredient, CAST(sum(sign) AS BIGINT) AS n_used
        FROM entries JOIN pantry USING (ingredient_id) JOIN runs USING (ok)
        WHERE NOT cancelled GROUP BY ingredient""",
    ),
    "revenue_with_extras": with_ctes(
        INGREDIENTS,
        LINES,
        NAMED_LINES,
        query="""
        SELECT CAST(sum(price) AS BIGINT) AS revenue FROM (
          SELECT CASE WHEN item = 'PROMO' THEN 12 ELSE 10 END AS price FROM named_items
          UNION ALL
          SELECT CASE WHEN ingredient = 'Feta' THEN 2 ELSE 1 END
          FROM (SELECT CAST(trim(unnest(string_split(added, ','))) AS INTEGER) AS ingredient_id FROM named_items)
          JOIN pantry USING (ingredient_id))""",
    ),
    "append_new_item": """
        SELECT p_partkey, p_name FROM part UNION ALL SELECT -1, 'house special'""",
    "append_all_ingredients_recipe": with_ctes(
        INGREDIENTS,
        RECIPES,
        RECIPE_TEXT,
        query="""
        SELECT recipe_item, recipe FROM recipe_text
        UNION ALL
        SELECT 'HOUSE SPECIAL', string_agg(CAST(ingredient_id AS VARCHAR), ', ' ORDER BY ingredient_id) FROM pantry""",
    ),
    "tuple_dump_load": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS placed_on,
               CASE WHEN o_orderkey % 20 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS total,
               CASE WHEN o_orderkey % 10 = 3 THEN o_orderpriority || ', it''s' || chr(10) || 'due' ELSE o_orderpriority END AS priority
        FROM orders WHERE o_orderkey % 50 NOT IN (7, 9, 11)""",
    "tuple_dump_rejects": """
        SELECT '  (''' || o_orderkey || ''', '
               || CASE WHEN o_orderkey % 3 = 0 THEN '' || o_custkey ELSE '''' || o_custkey || '''' END
               || CASE o_orderkey % 50 WHEN 7 THEN ', ''not a date''' WHEN 9 THEN ''
                    ELSE ', ''' || CAST(o_orderdate AS DATE) || '''' END
               || CASE WHEN o_orderkey % 20 = 0 THEN ', null'
                    ELSE ', ''' || CAST(o_totalprice AS DECIMAL(12,2)) || '''' END
               || ', ''' || o_orderpriority || CASE WHEN o_orderkey % 10 = 3 THEN ', it''''s due' ELSE '' END || ''''
               || CASE WHEN o_orderkey % 50 = 11 THEN '' ELSE '),' END AS "value",
               CASE o_orderkey % 50 WHEN 7 THEN 'bad value for placed_on' WHEN 9 THEN 'wrong number of fields'
                 ELSE 'malformed tuple' END AS reason
        FROM orders WHERE o_orderkey % 50 IN (7, 9, 11)""",
}

_RATINGS = with_ctes(
    LINES,
    DELIVERIES,
    query="""
    SELECT DISTINCT ok AS order_id, customer_id, runner_id, ok * 7 % 5 + 1 AS rating
    FROM order_items JOIN runs USING (ok)""",
)
SQL["ratings_preview"] = SQL["ratings_build"] = _RATINGS
