from __future__ import annotations

from tallyline.oracles.parts import half_up, with_ctes

CLICKS = """
clicks AS (
  SELECT user_id || '-' || CAST(ts AS DATE) AS visit_id, user_id, ts,
         user_id || '-w' || ((CAST(ts AS DATE) - DATE '2024-01-01') // 7) AS cookie_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 13 + 1 AS page_id,
         event_type AS word
  FROM events)
"""

PAGES = """
site(page_id, page_name, category) AS (VALUES
  (1, 'Landing', NULL), (2, 'Catalogue', NULL), (12, 'Basket Review', NULL), (13, 'Thank You', NULL),
  (3, 'Desk Lamp', 'Lighting'), (4, 'Floor Lamp', 'Lighting'), (5, 'Lantern', 'Lighting'),
  (6, 'Armchair', 'Seating'), (7, 'Bench', 'Seating'), (8, 'Stool', 'Seating'),
  (9, 'Bookcase', 'Storage'), (10, 'Drawer Unit', 'Storage'), (11, 'Shelf', 'Storage'))
"""

WORDS = """
labels_of(word, event_name) AS (VALUES
  ('view', 'Page View'), ('signup', 'Cart Add'), ('purchase', 'Purchase'), ('error', 'Ad Impression'),
  ('click', 'Ad Click'))
"""

BUYERS = "buyers AS (SELECT DISTINCT visit_id FROM clicks WHERE word = 'purchase')"

CAMPAIGNS = """
promos(campaign_name, starts, ends) AS (VALUES
  ('New Year Lights', TIMESTAMP '2024-01-03 00:00:00', TIMESTAMP '2024-01-09 12:00:00'),
  ('Sit Down Sale', TIMESTAMP '2024-01-12 00:00:00', TIMESTAMP '2024-01-16 23:59:59'),
  ('Tidy Home', TIMESTAMP '2024-01-24 06:30:00', TIMESTAMP '9999-12-31 00:00:00'))
"""


def _funnel_cte(group: str) -> str:
    return f"""
    steps AS (
      SELECT {group},
             count(*) FILTER (WHERE word = 'view') AS n_views,
             count(*) FILTER (WHERE word = 'signup') AS n_adds,
             count(*) FILTER (WHERE word = 'signup' AND visit_id NOT IN (SELECT visit_id FROM buyers)) AS n_abandons,
             count(*) FILTER (WHERE word = 'signup' AND visit_id IN (SELECT visit_id FROM buyers)) AS n_purchases
      FROM clicks JOIN site USING (page_id)
      WHERE category IS NOT NULL AND word IN ('view', 'signup', 'purchase')
      GROUP BY {group})
    """


def _funnel(group: str, query: str = "SELECT * FROM steps") -> str:
    return with_ctes(CLICKS, PAGES, BUYERS, _funnel_cte(group), query=query)


def _rate(out: str, part: str, whole: str) -> str:
    return _funnel("page_name", f"SELECT page_name, {half_up(f'100 * {part}', whole, 2)} AS {out} FROM steps")


def _share(counts: str, key: str, keep_count: bool) -> str:
    count = "n_visits, " if keep_count else ""
    return f"""SELECT {key}, {count}{half_up('100 * n_visits', 'sum(n_visits) OVER ()', 2)} AS visit_pct
      FROM ({counts})"""


def _views_and_adds(group: str) -> str:
    return with_ctes(
        CLICKS,
        PAGES,
        WORDS,
        query=f"""
        SELECT {group}, event_name, count(*) AS n_events
        FROM clicks JOIN site USING (page_id) JOIN labels_of USING (word)
        WHERE category IS NOT NULL AND word IN ('view', 'signup') GROUP BY ALL""",
    )


_PRODUCTS = _funnel("page_name")

_VISITS = with_ctes(
    CLICKS,
    CAMPAIGNS,
    """visits AS (
      SELECT visit_id, min(user_id) AS user_id, min(ts) AS visit_start,
             count(*) FILTER (WHERE word = 'view') AS n_views,
             count(*) FILTER (WHERE word = 'signup') AS n_cart_adds,
             CAST(bool_or(word = 'purchase') AS BIGINT) AS flag_purchase,
             count(*) FILTER (WHERE word = 'error') AS n_impressions,
             count(*) FILTER (WHERE word = 'click') AS n_clicks
      FROM clicks GROUP BY visit_id)""",
    query="""
    SELECT visits.*, coalesce(campaign_name, 'No Campaign') AS campaign_name
    FROM visits LEFT JOIN promos ON visit_start BETWEEN starts AND ends""",
)

SQL = {
    "signups_per_week": """
        SELECT (CAST(ts AS DATE) - DATE '2024-01-01') // 7 + 1 AS week, count(*) AS n_signups
        FROM events WHERE event_type = 'signup' GROUP BY ALL""",
    "distinct_users": "SELECT count(DISTINCT user_id) AS n_users FROM events",
    "avg_cookies_per_user": with_ctes(
        CLICKS,
        query=f"""
        SELECT {half_up('count(DISTINCT cookie_id)', 'count(DISTINCT user_id)', 2)} AS avg_cookies FROM clicks""",
    ),
    "visits_per_month": with_ctes(
        CLICKS,
        query="SELECT strftime(ts, '%Y-%m') AS month, count(DISTINCT visit_id) AS n_visits FROM clicks GROUP BY ALL",
    ),
    "events_per_type": with_ctes(
        WORDS,
        query="""
        SELECT event_name, count(*) AS n_events FROM events LEFT JOIN labels_of ON word = event_type GROUP BY ALL""",
    ),
    "categories_not_in": with_ctes(
        CLICKS,
        PAGES,
        "seen AS (SELECT DISTINCT page_id, category FROM clicks JOIN site USING (page_id))",
        "probes AS (SELECT DISTINCT category FROM seen)",
        query="""
        SELECT 'product pages' AS members, category FROM probes
        WHERE category NOT IN (SELECT category FROM seen WHERE page_id BETWEEN 3 AND 6)
        UNION ALL SELECT 'all first pages', category FROM probes
        WHERE category NOT IN (SELECT category FROM seen WHERE page_id <= 6)
        UNION ALL SELECT 'no pages', category FROM probes
        WHERE category NOT IN (SELECT category FROM seen WHERE page_id > 13)""",
    ),
    "purchase_visit_share": with_ctes(
        CLICKS,
        query=_share(
            """SELECT CASE WHEN bought THEN 'purchase' ELSE 'no purchase' END AS flag_purchase, count(*) AS n_visits
               FROM (SELECT visit_id, bool_or(word = 'purchase') AS bought FROM clicks GROUP BY visit_id)
               GROUP BY ALL""",
            "flag_purchase",
            True,
        ),
    ),
    "checkout_without_purchase": with_ctes(
        CLICKS,
        BUYERS,
        query=_share(
            """SELECT CAST(visit_id IN (SELECT visit_id FROM buyers) AS BIGINT) AS flag_purchase, count(*) AS n_visits
               FROM (SELECT DISTINCT visit_id FROM clicks WHERE page_id = 12) GROUP BY ALL""",
            "flag_purchase",
            False,
        ),
    ),
    "top_pages_by_views": with_ctes(
        CLICKS,
        PAGES,
        query="""
        SELECT page_name, count(*) AS n_views FROM clicks JOIN site USING (page_id) WHERE word = 'view'
        GROUP BY page_name ORDER BY n_views DESC, page_name LIMIT 3""",
    ),
    "views_and_adds_by_page": _views_and_adds("page_name"),
    "views_and_adds_by_category": _views_and_adds("category"),
    "top_products_by_purchase": _funnel(
        "page_name",
        "SELECT page_name, n_purchases FROM steps ORDER BY n_purchases DESC, page_name LIMIT 3",
    ),
    "product_funnel": _PRODUCTS,
    "category_funnel": _funnel("category"),
    "product_funnel_by_views": _PRODUCTS,
    "funnel_table": _PRODUCTS,
    "funnel_ranked": _PRODUCTS,
    "abandon_rate": _rate("abandon_rate", "n_abandons", "n_adds"),
    "view_to_purchase_rate": _rate("purchase_to_view_rate", "n_purchases", "n_views"),
    "view_to_add_rate": _rate("add_to_view_rate", "n_adds", "n_views"),
    "add_to_purchase_rate": _rate("purchase_to_add_rate", "n_purchases", "n_adds"),
    "visit_campaign_report": _VISITS,
    "visit_campaign_report_compact": _VISITS,
}
