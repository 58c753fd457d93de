"""The medallion layers as SQL text, for users who prefer CREATE TABLE AS SELECT.

Same semantics as the DataFrame operators: safe casts, guarded ratios, windows
per listing, rounding away from zero, and a volume rank that never sorts a
whole day in one task.
"""

import uuid

from barworks.functions.numeric import TIE_NUDGE
from barworks.operators.ranks import RANGE_BITS
from barworks.session import delete_path, qualified_path


def _rounded(x, scale):
    return f"(round({x} + signum({x}) * {TIE_NUDGE!r}D, {scale}) + 0.0D)"


def silver_select(bronze):
    """Distinct typed rows (no natural-key dedupe)."""
    prices = ",\n  ".join(
        f"try_cast({c} AS DOUBLE) AS {c}" for c in ("open_price", "high_price", "low_price", "close_price"))
    return f"""
SELECT DISTINCT
  symbol,
  exchange_code,
  try_cast(trade_date AS DATE) AS trade_date,
  {prices},
  try_cast(volume AS BIGINT) AS volume,
  try_cast(daily_range AS DOUBLE) AS daily_range,
  try_cast(change_pct AS DOUBLE) AS change_pct,
  source
FROM {bronze}
WHERE symbol IS NOT NULL
  AND try_cast(trade_date AS DATE) IS NOT NULL
  AND try_cast(close_price AS DOUBLE) IS NOT NULL
  AND NOT isnan(try_cast(close_price AS DOUBLE))"""


def gold_select(silver):
    """Moving averages, daily return and volume rank."""
    listing = "PARTITION BY symbol, exchange_code ORDER BY trade_date"
    change = "(close_price - prev_close) / nullif(prev_close, 0) * 100"
    return f"""
WITH windowed AS (
  SELECT *,
    avg(close_price) OVER ({listing} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_7,
    avg(close_price) OVER ({listing} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS avg_30,
    lag(close_price, 1) OVER ({listing}) AS prev_close
  FROM {silver}
),
volumes AS (
  SELECT trade_date, volume, shiftright(volume, {RANGE_BITS}) AS span
  FROM {silver} WHERE volume IS NOT NULL GROUP BY trade_date, volume
),
spans AS (
  SELECT trade_date, span,
    coalesce(sum(count(*)) OVER (
      PARTITION BY trade_date ORDER BY span DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS values_above,
    sum(count(*)) OVER (PARTITION BY trade_date) AS values_all
  FROM volumes GROUP BY trade_date, span
),
ranked AS (
  SELECT v.trade_date, v.volume,
    s.values_above + row_number() OVER (PARTITION BY v.trade_date, v.span ORDER BY v.volume DESC) AS place
  FROM volumes v JOIN spans s ON v.trade_date = s.trade_date AND v.span = s.span
),
days AS (SELECT trade_date, max(values_all) AS values_all FROM spans GROUP BY trade_date)
SELECT w.* EXCEPT (avg_7, avg_30, prev_close),
  {_rounded('w.avg_7', 2)} AS ma_7d,
  {_rounded('w.avg_30', 2)} AS ma_30d,
  {_rounded(change, 4)} AS daily_return_pct,
  coalesce(r.place, coalesce(d.values_all, 0) + 1) AS volume_rank
FROM windowed w
LEFT JOIN ranked r ON w.trade_date = r.trade_date AND w.volume = r.volume
LEFT JOIN days d ON w.trade_date = d.trade_date"""


def summary_select(gold):
    """Per day and exchange, with the spread of returns across stocks."""
    return f"""
SELECT trade_date, exchange_code,
  {_rounded('avg(daily_return_pct)', 4)} AS avg_return_pct,
  {_rounded('avg(close_price)', 2)} AS avg_close_price,
  sum(volume) AS total_volume,
  count(*) AS stock_count,
  {_rounded('stddev_samp(daily_return_pct)', 4)} AS return_volatility
FROM {gold}
WHERE daily_return_pct IS NOT NULL
GROUP BY trade_date, exchange_code"""


def create_table_as(spark, table, select, partition_by=None, location=None):
    """CREATE TABLE ... USING parquet AS SELECT, replacing an older table.

    The new table is complete under another name, and at ``location`` in a folder of its own, before the
    old one is moved aside; that goes last. A SELECT that fails leaves the old table as it was, and a
    stop between the two renames leaves both under their other names.
    """
    split = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    turn = uuid.uuid4().hex[:12]
    fresh, aside = f"{table}_new_{turn}", f"{table}_old_{turn}"
    place = f" LOCATION '{location.rstrip('/')}/{turn}'" if location else ""
    spark.sql(f"CREATE TABLE {fresh} USING parquet{split}{place} AS {select}")
    replaces = spark.catalog.tableExists(table)
    if replaces:
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    if replaces:
        old = spark.sql(f"DESCRIBE TABLE EXTENDED {aside}").filter("col_name = 'Location'").first()
        spark.sql(f"DROP TABLE {aside}")
        # What an earlier call wrote under the location is no table's any more.
        if location and qualified_path(spark, old.data_type).rsplit("/", 1)[0] == qualified_path(spark, location):
            delete_path(spark, old.data_type)
    return spark.table(table)
