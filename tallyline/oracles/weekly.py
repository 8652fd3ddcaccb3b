from __future__ import annotations

from tallyline.oracles.parts import half_up, with_ctes

WEEKLY = """
sold AS (
  SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS monday,
         CASE l_linestatus WHEN 'O' THEN 'Online' ELSE 'Store' END AS platform,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, r_name AS region, o_custkey AS ck,
         (o_custkey % 9 - 1) % 4 AS band
  FROM lineitem
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey),
weekly AS (
  SELECT monday AS week_date, CAST(weekofyear(monday) AS BIGINT) AS week_number,
         CAST(month(monday) AS BIGINT) AS month_number, CAST(year(monday) AS BIGINT) AS year_number,
         platform, region,
         CASE WHEN ck % 9 = 0 THEN 'Unknown' WHEN ck % 9 < 5 THEN 'Couples' ELSE 'Families' END AS demographic,
         CASE WHEN ck % 9 = 0 THEN 'Unknown' WHEN band = 0 THEN 'Young Adults' WHEN band = 1 THEN 'Middle Aged'
              ELSE 'Retirees' END AS age_band,
         CASE WHEN ck % 9 = 0 THEN 'Unknown' WHEN ck % 9 < 5 THEN 'C' || (band + 1) ELSE 'F' || (band + 1)
              END AS segment,
         CASE ck % 3 WHEN 0 THEN 'Guest' WHEN 1 THEN 'New' ELSE 'Existing' END AS customer_type,
         amount
  FROM sold)
"""

SALES = "CAST(sum(amount) AS DOUBLE)"


def _over(query: str) -> str:
    return with_ctes(WEEKLY, query=query)


def _pct(part: str, whole: str) -> str:
    return half_up(f"100 * ({part})", whole, 2)


def _shares(period: str, alias: str, group: str) -> str:
    return _over(f"""
        SELECT {alias}, {group},
               {_pct('n', 'sum(n) OVER (PARTITION BY ' + alias + ')')} AS transactions_pct,
               {_pct('cents', 'sum(cents) OVER (PARTITION BY ' + alias + ')')} AS sales_pct
        FROM (SELECT {period} AS {alias}, {group}, count(*) AS n, CAST(sum(amount) * 100 AS HUGEINT) AS cents
              FROM weekly GROUP BY ALL)""")


def _compare(period: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    over = f"(PARTITION BY {by})" if by else "()"
    return _over(f"""
        SELECT {keys}period, CAST(cents AS DOUBLE) / 100 AS sales,
               {_pct('cents', f"max(CASE WHEN period = 'before' THEN cents END) OVER {over}")} AS sales_index,
               {_pct('cents', f'sum(cents) OVER {over}')} AS sales_share
        FROM (SELECT {keys}{period} AS period, CAST(sum(amount) * 100 AS HUGEINT) AS cents FROM weekly GROUP BY ALL)
        WHERE period IS NOT NULL""")


def _around(weeks: int, day: str = "1998-06-15") -> str:
    change = f"DATE '{day}'"
    return f"""CASE WHEN week_date >= {change} - {7 * weeks} AND week_date < {change} THEN 'before'
        WHEN week_date >= {change} AND week_date < {change} + {7 * weeks} THEN 'after' END"""


_BY_WEEK = "CASE WHEN week_number BETWEEN 21 AND 24 THEN 'before' WHEN week_number BETWEEN 25 AND 28 THEN 'after' END"

SQL = {
    "weekly_sales_clean": _over(f"""
        SELECT week_date, week_number, month_number, year_number, platform, region, age_band, demographic, segment,
               customer_type, count(*) AS transactions, {SALES} AS sales,
               {half_up('CAST(sum(amount) * 100 AS HUGEINT)', '100 * count(*)', 2)} AS avg_transaction
        FROM weekly GROUP BY ALL"""),
    "weekday_per_week": _over(
        "SELECT DISTINCT week_number, CAST(dayofweek(week_date) AS BIGINT) AS day_of_week FROM weekly"
    ),
    "distinct_weekdays": _over("SELECT DISTINCT CAST(dayofweek(week_date) AS BIGINT) AS day_of_week FROM weekly"),
    "missing_weeks": """
        SELECT i AS week_number FROM range(1, 53) t(i) WHERE i NOT IN (SELECT weekofyear(ts) FROM events)""",
    "transactions_per_year": _over("SELECT year_number, count(*) AS transactions FROM weekly GROUP BY year_number"),
    "transactions_per_region_month": _over(f"""
        SELECT strftime(week_date, '%Y-%m') AS month, region, count(*) AS transactions, {SALES} AS sales
        FROM weekly GROUP BY ALL"""),
    "transactions_per_platform": _over("SELECT platform, count(*) AS transactions FROM weekly GROUP BY platform"),
    "platform_share_by_month": _shares("strftime(week_date, '%Y-%m')", "month", "platform"),
    "demographic_share_by_year": _shares("year_number", "year_number", "demographic"),
    "retail_share_by_two_groupings": _over(f"""
        SELECT year_number, group_name, {_pct('n', 'total')} AS transactions_pct FROM (
          SELECT year_number, demographic AS group_name, count(*) AS n FROM weekly
          WHERE platform = 'Store' GROUP BY ALL
          UNION
          SELECT year_number, age_band, count(*) FROM weekly WHERE platform = 'Store' GROUP BY ALL)
        JOIN (SELECT year_number, count(*) AS total FROM weekly WHERE platform = 'Store' GROUP BY ALL)
          USING (year_number)"""),
    "avg_ticket_by_platform_year": _over(f"""
        SELECT year_number, platform,
               {half_up('CAST(sum(amount) * 100 AS HUGEINT)', '100 * count(*)', 2)} AS avg_transaction
        FROM weekly GROUP BY ALL"""),
    "before_after_4w": _compare(_around(4)),
    "before_after_12w": _compare(_around(12)),
    "before_after_two_changes": f"""
        SELECT DATE '1996-03-11' AS change_date, * FROM ({_compare(_around(4, "1996-03-11"))})
        UNION ALL SELECT DATE '1998-06-15', * FROM ({_compare(_around(4))})""",
    "before_after_by_year": _compare(_BY_WEEK, "year_number"),
    "before_after_by_year_region": _compare(_BY_WEEK, "year_number, region"),
}
