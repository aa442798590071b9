"""DuckDB twins of the registered queries (the correctness oracle).

Each statement runs on the driver's parquet tables registered as views. The
common table expressions below restate, in plain SQL, the sales adapter, the
two-level rollup and the padded 31-day layout.
"""

from __future__ import annotations

SPLIT_DATE = "2000-01-01"
WINDOW_START = "2000-07-01"
WINDOW_END = "2000-07-15"

SALES = """
sales AS (
  SELECT CAST(l_suppkey AS VARCHAR)                                       AS item_number,
         l_returnflag || '-' || l_linestatus                              AS item_description,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) - l_linenumber*100 AS DOUBLE) AS state_bottle_cost,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE)    AS state_bottle_retail,
         CAST(l_linenumber * 250 AS BIGINT)                               AS bottle_volume_ml,
         CAST(l_linenumber AS BIGINT)                                     AS pack,
         CAST(l_shipdate AS DATE)                                         AS date,
         CAST(l_quantity AS BIGINT)                                       AS bottles_sold
  FROM lineitem)"""


EVENT_SALES = """
sales AS (
  SELECT CAST(user_id AS VARCHAR)              AS item_number,
         event_type                            AS item_description,
         CAST(round(value * 100) AS DOUBLE)    AS state_bottle_cost,
         CAST(round(value * 100) AS DOUBLE)    AS state_bottle_retail,
         CAST(750 AS BIGINT)                   AS bottle_volume_ml,
         CAST(12 AS BIGINT)                    AS pack,
         CAST(ts AS DATE)                      AS date,
         CAST(1 AS BIGINT)                     AS bottles_sold
  FROM events)"""


def daily_cte(where: str = "", name: str = "daily") -> str:
    return f"""
{name} AS (
  SELECT item_number, date,
         strftime(date, '%Y-%m')                   AS year_month,
         min(item_description)                     AS item_description,
         avg(state_bottle_cost)                    AS cost,
         avg(state_bottle_retail)                  AS retail,
         avg(bottle_volume_ml)                     AS volume_ml,
         avg(pack)                                 AS pack_size,
         CAST(sum(bottles_sold) AS BIGINT)         AS daily_bottles_sold
  FROM sales {where}
  GROUP BY item_number, date)"""


def monthly_cte(src: str = "daily", name: str = "monthly") -> str:
    return f"""
{name} AS (
  SELECT item_number, year_month,
         min(item_description)           AS item_description,
         arg_min(cost, date)             AS cost,
         arg_min(retail, date)           AS retail,
         arg_min(volume_ml, date)        AS volume_ml,
         arg_min(pack_size, date)        AS pack_size,
         max(date)                       AS last_date,
         CAST(sum(daily_bottles_sold) AS BIGINT) AS total
  FROM {src}
  GROUP BY item_number, year_month)"""


MONTHLY = monthly_cte()

STATS = """
stats AS (
  SELECT min(volume_ml) FILTER (WHERE NOT isnan(volume_ml)) AS volume_ml_min,
         max(volume_ml) FILTER (WHERE NOT isnan(volume_ml)) AS volume_ml_max,
         min(pack_size) FILTER (WHERE NOT isnan(pack_size)) AS pack_size_min,
         max(pack_size) FILTER (WHERE NOT isnan(pack_size)) AS pack_size_max
  FROM full_monthly)"""


def scaled_sql(col: str) -> str:
    return (
        f"CASE WHEN stats.{col}_max = stats.{col}_min THEN 0.5 "
        f"ELSE ({col} - stats.{col}_min) / (stats.{col}_max - stats.{col}_min) END"
    )

PADDED = """
real_days AS (
  SELECT item_number, year_month,
         CAST(dayofmonth(date) AS BIGINT) AS dom,
         daily_bottles_sold AS qty,
         sum(daily_bottles_sold) OVER (PARTITION BY item_number, year_month ORDER BY date
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumu
  FROM daily),
grid AS (
  SELECT m.*, CAST(g.d AS BIGINT) AS d
  FROM monthly m CROSS JOIN generate_series(1, 31) AS g(d)),
joined AS (
  SELECT grid.*, r.qty, r.cumu, r.dom IS NOT NULL AS is_real
  FROM grid LEFT JOIN real_days r
    ON r.item_number = grid.item_number AND r.year_month = grid.year_month AND r.dom = grid.d),
padded AS (
  SELECT item_description,
         CAST(item_number AS BIGINT)                                   AS item_id,
         CAST(split_part(year_month, '-', 1) AS BIGINT)                AS year,
         CAST(split_part(year_month, '-', 2) AS BIGINT) - 1            AS month,
         CAST(dayofmonth(last_date) AS BIGINT)                         AS last_valid_day,
         volume_ml, pack_size, cost, retail,
         d - 1                                                         AS day,
         CAST(CASE WHEN is_real THEN 1 ELSE 0 END AS BIGINT)           AS valid_day,
         CAST(coalesce(
            last_value(cumu IGNORE NULLS) OVER (PARTITION BY item_number, year_month ORDER BY d
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(cumu IGNORE NULLS) OVER (PARTITION BY item_number, year_month ORDER BY d
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS DOUBLE) AS cumu_bottles_sold,
         CAST(coalesce(
            last_value(qty IGNORE NULLS) OVER (PARTITION BY item_number, year_month ORDER BY d
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(qty IGNORE NULLS) OVER (PARTITION BY item_number, year_month ORDER BY d
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS DOUBLE) AS daily_bottles_sold,
         CAST(total AS DOUBLE) / pack_size                             AS total_packs_sold,
         item_number AS src_item, year_month AS src_ym, total
  FROM joined)"""

PADDED_COLS = (
    "item_description, item_id, year, month, last_valid_day, volume_ml, pack_size, cost, retail, "
    "day, valid_day, cumu_bottles_sold, daily_bottles_sold, total_packs_sold"
)

CODED = """
coded AS (
  SELECT *, (CAST(item_number AS BIGINT) * 37 + CAST(substr(year_month, 1, 4) AS BIGINT)
             + CAST(substr(year_month, 6, 2) AS BIGINT)) % 97 AS r
  FROM monthly)"""

TWICE = "(SELECT 1 AS k UNION ALL SELECT 2 AS k) dup"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


FULL = with_ctes(SALES, daily_cte(), MONTHLY, PADDED)
EVENTS = with_ctes(EVENT_SALES, daily_cte(), MONTHLY, PADDED)
# full-table statistics next to the (possibly windowed) padded layout
FULL_STATS = with_ctes(SALES, daily_cte(name="full_daily"), monthly_cte("full_daily", "full_monthly"), STATS,
                       daily_cte(), MONTHLY, PADDED)
WINDOW_STATS = with_ctes(SALES, daily_cte(name="full_daily"), monthly_cte("full_daily", "full_monthly"), STATS,
                         daily_cte(f"WHERE date BETWEEN DATE '{WINDOW_START}' AND DATE '{WINDOW_END}'"), MONTHLY, PADDED)
WINDOW = with_ctes(SALES, daily_cte(f"WHERE date BETWEEN DATE '{WINDOW_START}' AND DATE '{WINDOW_END}'"), MONTHLY, PADDED)
