"""ANSI SQL that states the expected result of each registered query."""


def r(x, n):
    """Round half away from zero, never negative zero."""
    return f"(round(({x}) + sign({x}) * 1e-9, {n}) + 0.0)"


def pct(new, old, n):
    return r(f"(({new}) - ({old})) / nullif({old}, 0) * 100", n)


def d(c):
    return f"CAST({c} AS DOUBLE)"


BARS = """
ticks AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
    CASE WHEN l_linestatus = 'O' THEN 'NSE' ELSE 'BSE' END AS exchange_code,
    CAST(l_shipdate AS DATE) AS trade_date,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS px,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS discounted,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS taxed,
    CAST(l_quantity AS BIGINT) AS quantity,
    row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_discount) AS seq
  FROM lineitem
),
bars AS (
  SELECT symbol, exchange_code, trade_date,
    arg_min(discounted, seq) AS open_price, max(taxed) AS high_price, min(discounted) AS low_price,
    arg_max(px, seq) AS close_price, CAST(sum(quantity) AS BIGINT) AS volume
  FROM ticks GROUP BY symbol, exchange_code, trade_date
)"""

# typed: double prices, the shape of a clean silver layer.
TYPED = BARS + f""",
typed AS (
  SELECT symbol, exchange_code, trade_date, {d('open_price')} AS open_price, {d('high_price')} AS high_price,
    {d('low_price')} AS low_price, {d('close_price')} AS close_price, volume
  FROM bars
)"""

FACT = TYPED + f""",
fact AS (
  SELECT *, {r('high_price - low_price', 4)} AS daily_range,
    {pct('close_price', 'open_price', 4)} AS change_pct, 'feed' AS source
  FROM typed
)"""

DIRTY = BARS + f""",
clean AS (
  SELECT *, {r(d('high_price') + ' - ' + d('low_price'), 4)} AS daily_range,
    {pct(d('close_price'), d('open_price'), 4)} AS change_pct,
    (CAST(substr(symbol, 2) AS BIGINT) * 31 + date_diff('day', DATE '1995-01-01', trade_date)) % 100 AS kind
  FROM bars
),
copies AS (
  SELECT *, 0 AS copy FROM clean UNION ALL SELECT *, 1 AS copy FROM clean WHERE kind IN (2, 3)
),
dirty AS (
  SELECT
    CASE WHEN kind = 7 THEN ' ' || lower(symbol) || ' ' ELSE symbol END AS symbol, exchange_code,
    CASE WHEN kind = 8 THEN 'bad' ELSE CAST(trade_date AS VARCHAR) END AS trade_date,
    CASE WHEN kind = 4 THEN '0' ELSE CAST(open_price AS VARCHAR) END AS open_price,
    CASE WHEN kind = 5 THEN CAST(low_price AS VARCHAR) ELSE CAST(high_price AS VARCHAR) END AS high_price,
    CASE WHEN kind = 5 THEN CAST(high_price AS VARCHAR) ELSE CAST(low_price AS VARCHAR) END AS low_price,
    CASE WHEN kind = 0 THEN NULL WHEN kind = 1 THEN 'n/a'
      WHEN kind = 2 AND copy = 1 THEN CAST(CAST(close_price + 1 AS DECIMAL(18,4)) AS VARCHAR)
      WHEN kind = 3 AND copy = 1 THEN NULL
      WHEN kind = 9 THEN 'NaN' ELSE CAST(close_price AS VARCHAR) END AS close_price,
    CASE WHEN kind = 6 THEN -volume ELSE volume END AS volume,
    daily_range, change_pct, 'feed' AS source, copy
  FROM copies
),
casted AS (
  SELECT symbol, exchange_code, TRY_CAST(trade_date AS DATE) AS trade_date,
    TRY_CAST(open_price AS DOUBLE) AS open_price, TRY_CAST(high_price AS DOUBLE) AS high_price,
    TRY_CAST(low_price AS DOUBLE) AS low_price, TRY_CAST(close_price AS DOUBLE) AS close_price,
    volume, daily_range, change_pct, source, copy
  FROM dirty
),
filtered AS (
  SELECT * FROM casted
  WHERE symbol IS NOT NULL AND trade_date IS NOT NULL AND close_price IS NOT NULL AND NOT isnan(close_price)
),
silver AS (
  SELECT * EXCLUDE (copy, nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, exchange_code, trade_date ORDER BY copy DESC) AS nth
    FROM filtered) WHERE nth = 1
)"""

EVENT_BARS = """
event_bars AS (
  SELECT event_type AS symbol, CASE WHEN user_id % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange_code,
    CAST(ts AS DATE) AS trade_date,
    CAST(arg_min(CAST(value AS DECIMAL(12,2)), event_id) AS DOUBLE) AS open_price,
    CAST(max(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS high_price,
    CAST(min(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS low_price,
    CAST(arg_max(CAST(value AS DECIMAL(12,2)), event_id) AS DOUBLE) AS close_price,
    count(*) AS volume
  FROM events GROUP BY 1, 2, 3
)"""

LISTINGS = """
listings AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, e.exchange_code, s_name AS company_name,
    n_name AS industry, r_name AS sector
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    CROSS JOIN (VALUES ('NSE'), ('BSE')) AS e(exchange_code)
)"""


def gold_ctes(source, name="gold"):
    """CTEs that end in a gold table built from ``source``."""
    return f"""
{name}_lagged AS (
  SELECT *,
    avg(close_price) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS a7,
    avg(close_price) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS a30,
    lag(close_price) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date) AS prev,
    dense_rank() OVER (PARTITION BY trade_date ORDER BY volume DESC NULLS LAST) AS volume_rank
  FROM {source}
),
{name}_returns AS (
  SELECT * EXCLUDE (a7, a30, prev), {r('a7', 2)} AS ma_7d, {r('a30', 2)} AS ma_30d,
    {pct('close_price', 'prev', 4)} AS daily_return_pct
  FROM {name}_lagged
),
{name} AS (
  SELECT * EXCLUDE (sd), {r('sd', 4)} AS volatility_30d FROM (
    SELECT *, stddev_samp(daily_return_pct) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date
      ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS sd
    FROM {name}_returns)
)"""


GOLD_OUT = "symbol, exchange_code, trade_date, close_price, ma_7d, ma_30d, daily_return_pct, volatility_30d, volume_rank"
BAR_OUT = "symbol, exchange_code, trade_date, open_price, high_price, low_price, close_price, volume"
KEY = "symbol, exchange_code, trade_date"


def summary(gold, spread, group="trade_date, exchange_code"):
    return f"""
SELECT {group}, {r('avg(daily_return_pct)', 4)} AS avg_return_pct, {r('avg(close_price)', 2)} AS avg_close_price,
  CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS stock_count, {spread}
FROM {gold} WHERE daily_return_pct IS NOT NULL GROUP BY {group}"""


AVG_VOL = r("avg(volatility_30d)", 4) + " AS avg_volatility"
RET_VOL = r("stddev_samp(daily_return_pct)", 4) + " AS return_volatility"

MONTHLY = FACT + f""",
months AS (
  SELECT symbol, exchange_code, CAST(date_trunc('month', trade_date) AS DATE) AS month_start,
    arg_min(close_price, trade_date) AS month_open, arg_max(close_price, trade_date) AS month_close
  FROM fact GROUP BY 1, 2, 3
),
monthly AS (SELECT *, {pct('month_close', 'month_open', 2)} AS monthly_return_pct FROM months)"""

CALENDAR = FACT + """,
calendar AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_key
  FROM (SELECT min(trade_date) AS lo, max(trade_date) AS hi FROM fact)
),
dim_date AS (
  SELECT date_key, CAST(isodow(date_key) AS BIGINT) AS day_of_week, strftime(date_key, '%a') AS day_name,
    CAST(day(date_key) AS BIGINT) AS day_of_month, CAST(dayofyear(date_key) AS BIGINT) AS day_of_year,
    CAST(weekofyear(date_key) AS BIGINT) AS week_of_year, CAST(month(date_key) AS BIGINT) AS month_number,
    strftime(date_key, '%b') AS month_name, CAST(quarter(date_key) AS BIGINT) AS quarter,
    CAST(year(date_key) AS BIGINT) AS year, isodow(date_key) IN (6, 7) AS is_weekend,
    isodow(date_key) NOT IN (6, 7) AS is_trading_day,
    last_day(date_key) = date_key AS is_month_end,
    last_day(date_key) = date_key AND month(date_key) IN (3, 6, 9, 12) AS is_quarter_end,
    CAST(year(date_key) + CASE WHEN month(date_key) >= 4 THEN 1 ELSE 0 END AS BIGINT) AS fiscal_year,
    CAST(CASE WHEN month(date_key) BETWEEN 4 AND 6 THEN 1 WHEN month(date_key) BETWEEN 7 AND 9 THEN 2
      WHEN month(date_key) BETWEEN 10 AND 12 THEN 3 ELSE 4 END AS BIGINT) AS fiscal_quarter
  FROM calendar
)"""

BAR_RULES = [
    ("symbol_missing", "symbol IS NULL"),
    ("trade_date_missing", "trade_date IS NULL"),
    *[(f"{c}_missing", f"{c} IS NULL OR isnan({c})") for c in ("open_price", "high_price", "low_price", "close_price")],
    *[(f"{c}_negative", f"{c} < 0") for c in ("open_price", "high_price", "low_price", "close_price", "volume")],
    *[(f"{c}_not_finite", f"isinf({c})") for c in ("open_price", "high_price", "low_price", "close_price")],
    ("volume_unparsable", "no_volume"),
    ("high_below_low", "high_price < low_price"),
]
CONTRACT = DIRTY.replace(
    "CASE WHEN kind = 7 THEN", "CASE WHEN kind = 15 THEN NULL WHEN kind = 7 THEN").replace(
    "CASE WHEN kind = 4 THEN '0'", "CASE WHEN kind = 14 THEN 'Infinity' WHEN kind = 4 THEN '0'").replace(
    "CASE WHEN kind = 6 THEN -volume ELSE volume END AS volume",
    """CASE WHEN kind = 10 THEN 'x' WHEN kind = 11 THEN '1.5' WHEN kind = 12 THEN CAST(volume AS VARCHAR) || '.0'
      WHEN kind = 13 THEN NULL WHEN kind = 6 THEN CAST(-volume AS VARCHAR) ELSE CAST(volume AS VARCHAR) END AS volume""") + """,
contract AS (
  SELECT *, [""" + ", ".join(
    f"CASE WHEN {cond} THEN '{name}' END" for name, cond in BAR_RULES) + """] AS rules,
    concat_ws(',', """ + ", ".join(
    f"CASE WHEN {cond} THEN '{name}' END" for name, cond in BAR_RULES) + """) AS violations
  FROM (
    SELECT * REPLACE (CASE WHEN NOT no_volume THEN coalesce(CAST(TRY_CAST(volume AS DOUBLE) AS BIGINT), 0) END AS volume) FROM (
      SELECT * REPLACE (upper(trim(symbol)) AS symbol),
        volume IS NOT NULL AND (TRY_CAST(volume AS DOUBLE) IS NULL OR TRY_CAST(volume AS DOUBLE) <> floor(TRY_CAST(volume AS DOUBLE))) AS no_volume
      FROM casted))
)"""


def checks(rows):
    """Result rows of a suite over ``casted``: (name, severity, failed, checked[, passed])."""
    parts = []
    for number, (name, severity, failed, checked, *passed) in enumerate(rows, start=1):
        ok = passed[0] if passed else "failed_rows = 0"
        parts.append(f"""
SELECT CAST({number} AS BIGINT) AS check_no, '{name}' AS check_name, '{severity}' AS severity, {ok} AS passed,
  failed_rows, checked_rows, coalesce({r('failed_rows / nullif(checked_rows, 0) * 100', 1)}, 0.0) AS failed_pct
FROM (SELECT CAST({failed} AS BIGINT) AS failed_rows, CAST({checked} AS BIGINT) AS checked_rows FROM {{source}})""")
    return " UNION ALL ".join(parts)


def nulls(c, floating=False):
    cond = f"{c} IS NULL" + (f" OR isnan({c})" if floating else "")
    return f"count(*) FILTER (WHERE {cond})"


def below(c, floating=True):
    present = f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if floating else "")
    return f"count(*) FILTER (WHERE {present} AND {c} < 0)", f"count(*) FILTER (WHERE {present})"


def duplicates(columns):
    return f"count(*) - count(DISTINCT row({columns}))", "count(*)"


NOT_NULLS = [("not_null(symbol)", "CRITICAL", nulls("symbol"), "count(*)"),
             ("not_null(trade_date)", "CRITICAL", nulls("trade_date"), "count(*)"),
             ("not_null(close_price)", "CRITICAL", nulls("close_price", True), "count(*)")]
RANGES = [(f"in_range({c}, 0..None)", "CRITICAL", *below(c, c != "volume"))
          for c in ("open_price", "high_price", "low_price", "close_price", "volume")]
ROW_COUNT = ("row_count(1..None)", "CRITICAL", "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END", "count(*)")
ONE_PER_KEY = ("unique(symbol+exchange+date)", "WARN", *duplicates(KEY))
SCHEMA = ("schema_match(8 cols)", "WARN", "0 * count(*)", "8 + 0 * count(*)")
BAR_SUITE = [*NOT_NULLS, *RANGES, ROW_COUNT, ONE_PER_KEY, SCHEMA]


def suite(rows, source="casted", ctes=DIRTY):
    return f"WITH {ctes} {checks(rows).format(source=source)}"


def counted(tables):
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables)


UPSERT = FACT + """,
target AS (SELECT * FROM fact WHERE trade_date < DATE '1999-01-01'),
batch AS (SELECT * REPLACE (close_price + 1 AS close_price) FROM fact WHERE trade_date >= DATE '1997-01-01')"""

STATE = FACT + """,
state AS (
  SELECT symbol, exchange_code, max(trade_date) AS watermark FROM fact
  WHERE exchange_code = 'NSE' AND trade_date < DATE '1997-01-01' GROUP BY 1, 2
)"""


def rolling_sql(columns):
    return f"WITH {TYPED}, {gold_ctes('typed')} SELECT {KEY}, {columns} FROM gold"


def oracle_sql(tables):
    out = {
        # scans and sources
        "scan_bronze": "SELECT l_suppkey, CAST(l_shipdate AS DATE) AS trade_date, l_extendedprice AS price, l_quantity AS quantity FROM lineitem",
        "normalize_bars": f"WITH {FACT} SELECT {BAR_OUT}, daily_range, change_pct, 'yfinance' AS source FROM fact",
        "union_symbol_frames": f"""WITH {TYPED} SELECT {KEY}, close_price,
            CASE WHEN exchange_code = 'NSE' THEN volume ELSE -1 END AS volume FROM typed""",
        "bars_from_ticks": f"WITH {EVENT_BARS} SELECT {BAR_OUT} FROM event_bars",
        "resample_weekly": f"""WITH {TYPED} SELECT *, {r('high_price - low_price', 4)} AS daily_range,
            {pct('close_price', 'open_price', 4)} AS change_pct FROM (
            SELECT symbol, exchange_code, CAST(date_trunc('week', trade_date) AS DATE) AS period_start,
              arg_min(open_price, trade_date) AS open_price, max(high_price) AS high_price, min(low_price) AS low_price,
              arg_max(close_price, trade_date) AS close_price, CAST(sum(volume) AS BIGINT) AS volume,
              count(*) AS trading_days FROM typed GROUP BY 1, 2, 3)""",
        "resample_monthly": f"""WITH {TYPED} SELECT *, {r('high_price - low_price', 4)} AS daily_range,
            {pct('close_price', 'open_price', 4)} AS change_pct FROM (
            SELECT symbol, exchange_code, CAST(date_trunc('month', trade_date) AS DATE) AS period_start,
              arg_min(open_price, trade_date) AS open_price, max(high_price) AS high_price, min(low_price) AS low_price,
              arg_max(close_price, trade_date) AS close_price, CAST(sum(volume) AS BIGINT) AS volume,
              count(*) AS trading_days FROM typed GROUP BY 1, 2, 3)""",
        "table_counts": counted(tables),
        "table_list": " UNION ALL ".join(f"SELECT 'given_{t}' AS table_name, 'VIEW' AS table_type, count(*) AS row_count FROM {t}" for t in tables),
        "param_query": f"""WITH {FACT} SELECT symbol, exchange_code, count(*) AS up_days, max(change_pct) AS best_change
            FROM fact WHERE change_pct > 0.5 GROUP BY 1, 2""",
        # projections
        "silver_cast": f"WITH {DIRTY} SELECT {BAR_OUT} FROM casted",
        "silver_filter": f"WITH {DIRTY} SELECT {BAR_OUT} FROM filtered",
        "dedupe_bars": f"WITH {DIRTY} SELECT {KEY}, close_price, open_price FROM silver",
        "bronze_to_silver": f"WITH {DIRTY} SELECT {BAR_OUT}, daily_range, change_pct, source FROM silver",
        "derived_columns": f"WITH {FACT} SELECT {KEY}, daily_range, change_pct FROM fact",
        "derived_columns_2dp": f"""WITH {DIRTY} SELECT {KEY}, {r('high_price - low_price', 2)} AS daily_range,
            {r('close_price - open_price', 2)} AS change_from_open,
            CASE WHEN open_price = 0 THEN 0.0 ELSE {pct('close_price', 'open_price', 2)} END AS change_pct FROM silver""",
        # contracts
        "row_contract_bars": f"""WITH {CONTRACT} SELECT symbol, exchange_code, coalesce(CAST(trade_date AS VARCHAR), 'none') AS trade_date,
            volume, CAST(copy AS BIGINT) AS late_copy, violations FROM contract""",
        "row_contract_symbols": """SELECT upper(trim(name)) AS symbol, code AS exchange_code,
            concat_ws(',', CASE WHEN trim(name) = '' THEN 'symbol_empty' END,
              CASE WHEN code NOT IN ('NSE', 'BSE') THEN 'exchange_unknown' END) AS violations
            FROM (SELECT CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE c_name END AS name,
              CASE WHEN c_custkey % 3 = 0 THEN 'NSE' WHEN c_custkey % 3 = 1 THEN 'BSE' ELSE 'NYSE' END AS code FROM customer)""",
        "quarantine_counts": f"WITH {CONTRACT} SELECT reason, count(*) AS row_count FROM (SELECT unnest(rules) AS reason FROM contract) WHERE reason IS NOT NULL GROUP BY reason",
        "valid_bars": f"WITH {CONTRACT} SELECT {BAR_OUT}, CAST(copy AS BIGINT) AS late_copy FROM contract WHERE violations = ''",
        # analytics
        "q1_price_stats": f"""WITH {FACT} SELECT symbol, exchange_code, count(*) AS total_trading_days,
            {r('avg(close_price)', 2)} AS avg_close_price, {r('min(close_price)', 2)} AS min_close_price,
            {r('max(close_price)', 2)} AS max_close_price, CAST(sum(volume) AS BIGINT) AS total_volume FROM fact GROUP BY 1, 2""",
        "q2_latest_price": f"""WITH {FACT} SELECT {BAR_OUT}, daily_range, change_pct, source FROM fact f
            JOIN (SELECT symbol, exchange_code, max(trade_date) AS trade_date FROM fact GROUP BY 1, 2) l USING (symbol, exchange_code, trade_date)""",
        "q5_gainers_losers": f"""WITH {FACT} SELECT * FROM (SELECT {KEY}, close_price, change_pct,
            rank() OVER (PARTITION BY trade_date, exchange_code ORDER BY change_pct DESC NULLS LAST) AS gain_rank,
            rank() OVER (PARTITION BY trade_date, exchange_code ORDER BY change_pct ASC NULLS LAST) AS loss_rank
            FROM fact WHERE change_pct IS NOT NULL) WHERE gain_rank <= 5 OR loss_rank <= 5""",
        "monthly_returns": f"WITH {MONTHLY} SELECT * FROM monthly",
        "q6_sector_monthly": f"""WITH {MONTHLY}, {LISTINGS} SELECT sector, month_start, count(DISTINCT m.symbol) AS stocks_in_sector,
            {r('avg(monthly_return_pct)', 2)} AS avg_sector_return_pct, {r('min(monthly_return_pct)', 2)} AS worst_stock_return_pct,
            {r('max(monthly_return_pct)', 2)} AS best_stock_return_pct
            FROM monthly m JOIN listings l ON m.symbol = l.symbol AND m.exchange_code = l.exchange_code
            WHERE sector IS NOT NULL AND sector <> '' GROUP BY 1, 2""",
        "q7_trading_days": f"""WITH {CALENDAR} SELECT month_name, year, fiscal_quarter, month_number,
            count(DISTINCT trade_date) AS trading_days, count(DISTINCT symbol) AS stocks_traded,
            {r('avg(close_price)', 2)} AS avg_close_across_all, CAST(sum(volume) AS BIGINT) AS total_volume
            FROM fact JOIN dim_date ON trade_date = date_key WHERE NOT is_weekend GROUP BY 1, 2, 3, 4""",
        "ingest_counts": f"WITH {BARS} SELECT count(*) AS row_count, count(DISTINCT symbol) AS symbol_count, count(DISTINCT row(symbol, exchange_code)) AS listing_count FROM bars",
        "watermark_candidates": f"WITH {BARS} SELECT symbol, exchange_code, max(trade_date) AS watermark FROM bars GROUP BY 1, 2",
        # gold
        "ma_7d": rolling_sql("ma_7d"),
        "ma_30d": rolling_sql("ma_30d"),
        "daily_return": rolling_sql("daily_return_pct"),
        "volatility_30d": rolling_sql("volatility_30d"),
        "volume_rank": rolling_sql("volume, volume_rank"),
        "avg_volume_7d": f"""WITH {TYPED} SELECT {KEY}, {r('av', 0)} AS avg_volume_7d FROM (SELECT *, avg(volume) OVER (
            PARTITION BY symbol, exchange_code ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS av FROM typed)""",
        "gold": f"WITH {DIRTY}, {gold_ctes('silver')} SELECT {GOLD_OUT} FROM gold",
        "daily_summary": f"WITH {DIRTY}, {gold_ctes('silver')} {summary('gold', AVG_VOL)}",
        "daily_summary_sql": f"WITH {DIRTY}, {gold_ctes('silver')} {summary('gold', RET_VOL)}",
        "medallion_run": f"WITH {DIRTY}, {gold_ctes('silver')} {summary('gold', AVG_VOL)}",
        "medallion_counts": f"""WITH {DIRTY}, {gold_ctes('silver')} SELECT 'silver' AS layer, count(*) AS row_count FROM silver
            UNION ALL SELECT 'gold', count(*) FROM gold
            UNION ALL SELECT 'summary', count(DISTINCT row(trade_date, exchange_code)) FROM gold WHERE daily_return_pct IS NOT NULL""",
        "sector_daily_summary": f"""WITH {DIRTY}, {gold_ctes('silver')}, {LISTINGS}, joined AS (
            SELECT gold.*, sector FROM gold JOIN listings ON gold.symbol = listings.symbol AND gold.exchange_code = listings.exchange_code)
            {summary('joined', AVG_VOL, 'trade_date, sector')}""",
        "silver_sql": f"WITH {DIRTY} SELECT DISTINCT {BAR_OUT}, daily_range, change_pct, source FROM filtered",
        "gold_sql": f"WITH {TYPED}, {gold_ctes('typed')} SELECT {KEY}, close_price, ma_7d, ma_30d, daily_return_pct, volume_rank FROM gold",
        "q4_moving_averages": f"""WITH {TYPED} SELECT {KEY}, close_price, {r('a7', 2)} AS ma_7day, {r('a30', 2)} AS ma_30day, {r('av', 0)} AS avg_volume_7day
            FROM (SELECT *, avg(close_price) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS a7,
              avg(close_price) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS a30,
              avg(volume) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS av FROM typed)""",
        "ma_cross": f"""WITH {TYPED}, {gold_ctes('typed')} SELECT {KEY}, ma_7d, ma_30d, signal FROM (
            SELECT *, CASE WHEN lag(side) OVER w <= 0 AND side > 0 THEN 'golden' WHEN lag(side) OVER w >= 0 AND side < 0 THEN 'death' END AS signal
            FROM (SELECT *, sign(ma_7d - ma_30d) AS side FROM gold) WINDOW w AS (PARTITION BY symbol, exchange_code ORDER BY trade_date))
            WHERE signal IS NOT NULL""",
        # dimensions
        "dim_date": f"WITH {CALENDAR} SELECT * EXCLUDE (is_month_end, is_quarter_end) FROM dim_date",
        "dim_date_flags": f"WITH {CALENDAR} SELECT date_key, is_month_end, is_quarter_end FROM dim_date",
        "dim_exchange": f"""WITH {BARS} SELECT exchange_code, exchange_code AS exchange_name, 'India' AS country, 'INR' AS currency, 'Asia/Kolkata' AS timezone
            FROM (SELECT DISTINCT exchange_code FROM bars WHERE exchange_code <> 'NSE')
            UNION ALL SELECT 'NSE', 'National Stock Exchange of India', 'India', 'INR', 'Asia/Kolkata'""",
        "dim_symbol_scd1": f"""WITH {BARS}, {LISTINGS} SELECT b.symbol, b.exchange_code, l.company_name, l.sector, l.industry, b.listed_date
            FROM (SELECT symbol, exchange_code, min(trade_date) AS listed_date FROM bars GROUP BY 1, 2) b
            JOIN listings l ON b.symbol = l.symbol AND b.exchange_code = l.exchange_code""",
        "star_schema_load": f"""WITH {CALENDAR} SELECT {BAR_OUT}, change_pct, day_name, CAST(fiscal_year AS BIGINT) AS fiscal_year, is_trading_day,
            exchange_code AS exchange_name,
            min(trade_date) OVER (PARTITION BY symbol, exchange_code) AS listed_date
            FROM fact JOIN dim_date ON date_key = trade_date""",
        # quality
        "qc_not_null": suite(NOT_NULLS),
        "qc_unique": suite([("unique(trade_date)", "CRITICAL", *duplicates("trade_date"))]),
        "qc_unique_composite": suite([ONE_PER_KEY]),
        "qc_in_range": suite(RANGES + [("in_range(volume, 0..100)", "CRITICAL", "count(*) FILTER (WHERE volume < 0 OR volume > 100)", "count(volume)")]),
        "qc_row_count": suite([ROW_COUNT, ("row_count(1..100)", "CRITICAL", "CASE WHEN count(*) BETWEEN 1 AND 100 THEN 0 ELSE 1 END", "count(*)")]),
        "qc_freshness": suite([
            ("freshness(trade_date, 3d)", "WARN", "CASE WHEN date_diff('day', max(trade_date), DATE '2024-02-01') <= 3 THEN 0 ELSE 1 END", "count(trade_date)"),
            ("freshness(trade_date, 0d)", "WARN", "CASE WHEN date_diff('day', max(trade_date), DATE '2024-02-01') <= 0 THEN 0 ELSE 1 END", "count(trade_date)"),
        ], "event_bars", EVENT_BARS),
        "qc_schema": suite([SCHEMA, ("schema_match(3 cols)", "CRITICAL", "1 + 0 * count(*)", "3 + 0 * count(*)"), ROW_COUNT]),
        "qc_custom": suite([("no_future_dates", "CRITICAL", "CASE WHEN max(trade_date) <= DATE '2000-01-01' THEN 0 ELSE 1 END", "count(*)")]),
        "qc_bar_suite": suite(BAR_SUITE),
        "qc_suite_summary": f"""WITH {DIRTY}, results AS ({checks(BAR_SUITE).format(source='casted')})
            SELECT 'bars' AS suite, count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
              count(*) FILTER (WHERE NOT passed AND severity = 'CRITICAL') AS critical,
              CASE WHEN count(*) FILTER (WHERE NOT passed AND severity = 'CRITICAL') = 0 THEN 'PASSED' ELSE 'FAILED' END AS status
            FROM results""",
        # incremental
        "incremental_extract": f"""WITH {STATE} SELECT f.symbol, f.exchange_code, f.trade_date, f.close_price FROM fact f
            LEFT JOIN state s ON f.symbol = s.symbol AND f.exchange_code = s.exchange_code
            WHERE f.trade_date < DATE '1999-01-01' AND CASE WHEN s.watermark IS NOT NULL THEN f.trade_date > s.watermark
              ELSE f.trade_date >= DATE '1998-01-01' END""",
        "period_extract": f"WITH {TYPED} SELECT {KEY}, close_price FROM typed WHERE trade_date BETWEEN DATE '1998-03-30' AND DATE '1998-06-30'",
        "watermark_advance": f"""WITH {STATE}, loaded AS (SELECT * FROM fact WHERE trade_date >= DATE '1996-06-01')
            SELECT symbol, exchange_code, max(watermark) AS watermark FROM (
              SELECT * FROM state UNION ALL SELECT symbol, exchange_code, max(trade_date) FROM loaded GROUP BY 1, 2) GROUP BY 1, 2""",
        "watermark_reset": f"""WITH {FACT} SELECT symbol, exchange_code, max(trade_date) AS watermark FROM fact
            WHERE exchange_code = 'NSE' GROUP BY 1, 2""",
        "upsert_bars": f"""WITH {UPSERT} SELECT {KEY}, close_price FROM target t
            WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.symbol = t.symbol AND b.exchange_code = t.exchange_code AND b.trade_date = t.trade_date)
            UNION ALL SELECT {KEY}, close_price FROM batch""",
        "upsert_counts": f"""WITH {UPSERT} SELECT count(*) FILTER (WHERE t.symbol IS NULL) AS inserted, count(*) FILTER (WHERE t.symbol IS NOT NULL) AS updated, count(*) AS affected
            FROM batch b LEFT JOIN target t ON b.symbol = t.symbol AND b.exchange_code = t.exchange_code AND b.trade_date = t.trade_date""",
        "insert_absent": f"""WITH {UPSERT} SELECT {KEY}, close_price FROM target
            UNION ALL SELECT {KEY}, close_price FROM batch WHERE trade_date >= DATE '1999-01-01'""",
        "upsert_table": f"WITH {BARS} SELECT {KEY}, {d("close_price + CASE WHEN trade_date >= DATE '1997-01-01' THEN 1 ELSE 0 END")} AS close_price, volume FROM bars",
        "gold_refresh": f"""WITH {TYPED}, corrected AS (SELECT * REPLACE (
              close_price + CASE WHEN trade_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-05' THEN 1 ELSE 0 END AS close_price,
              volume + CASE WHEN trade_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-05' THEN 7 ELSE 0 END AS volume)
            FROM typed), {gold_ctes('corrected')} SELECT {GOLD_OUT} FROM gold""",
        # streaming
        "stream_ingest": f"WITH {FACT} SELECT {BAR_OUT}, daily_range, change_pct FROM fact",
        "stream_daily_bars": f"WITH {EVENT_BARS} SELECT {BAR_OUT} FROM event_bars",
    }
    out["q7_one_fiscal_quarter"] = out["q7_trading_days"].replace("NOT is_weekend", "NOT is_weekend AND fiscal_year = 1997 AND fiscal_quarter = 2")
    out["listing_table_upsert"] = out["upsert_table"]
    corrected = "close_price + CASE WHEN trade_date >= DATE '1997-01-01' THEN 1 ELSE 0 END"
    over = "avg({}) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    out["listing_table_averages"] = f"""WITH {TYPED}, t AS (SELECT {KEY}, {d(corrected)} AS close_price, volume FROM typed),
        w AS (SELECT *, {over.format('close_price', 6)} AS a, {over.format('close_price', 29)} AS b, {over.format('volume', 6)} AS v FROM t)
        SELECT {KEY}, close_price, {r('a', 2)} AS ma_7day, {r('b', 2)} AS ma_30day, {r('v', 0)} AS avg_volume_7day FROM w"""
    out["month_bounds"] = f"""WITH {TYPED} SELECT CAST(date_trunc('month', trade_date) AS DATE) AS trade_month, count(*) AS row_count,
        min(trade_date) AS first_day, max(trade_date) AS last_day FROM typed GROUP BY 1"""
    out["normalize_zoned"] = out["normalize_bars"]
    out["ctas_silver"] = out["silver_sql"]
    out["load_quarantine"] = f"""WITH {CONTRACT} SELECT coalesce(symbol, 'none') AS symbol, exchange_code,
        coalesce(CAST(trade_date AS VARCHAR), 'none') AS trade_date, CAST(copy AS BIGINT) AS late_copy, violations FROM contract WHERE violations <> ''"""
    # Five arrivals of six days; a third of the ticks comes again with the next one, a few of the first only with the last.
    arrivals = """own AS (SELECT *, least(CAST(floor((day(ts) - 1) / 6) AS BIGINT), 4) AS slot FROM events),
        marked AS (SELECT *, slot = 0 AND event_id % 50 = 0 AS withheld FROM own),
        arriving AS (SELECT *, CASE WHEN withheld THEN 4 ELSE slot END AS batch_id FROM marked
          UNION ALL SELECT *, slot + 1 FROM marked WHERE NOT withheld AND event_id % 3 = 0 AND slot < 4)"""
    listed = "event_type AS symbol, CASE WHEN user_id % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange_code"
    out["stream_ticks_replayed"] = f"""WITH {arrivals}, t AS (SELECT {listed}, CAST(ts AS DATE) AS trade_date,
            CAST(value AS DECIMAL(12,2)) AS px, event_id FROM marked WHERE NOT withheld)
        SELECT symbol, exchange_code, trade_date, {d('arg_min(px, event_id)')} AS open_price, {d('max(px)')} AS high_price,
          {d('min(px)')} AS low_price, {d('arg_max(px, event_id)')} AS close_price, count(*) AS volume FROM t GROUP BY 1, 2, 3"""
    out["stream_late_ticks"] = f"""WITH {arrivals},
        latest AS (SELECT batch_id, max(date_trunc('millisecond', ts)) AS latest FROM arriving GROUP BY 1)
        SELECT event_id, {listed}, batch_id FROM arriving a
        WHERE ts <= (SELECT max(latest) FROM latest l WHERE l.batch_id < a.batch_id) - INTERVAL 7 DAY"""
    out["stream_metrics"] = f"""WITH {BARS}, year AS (SELECT CAST(year(trade_date) - 1996 AS VARCHAR) AS batch_id, count(*) AS rows_in,
            count(*) FILTER (WHERE volume % 10 = 0) AS bad FROM bars WHERE year(trade_date) BETWEEN 1996 AND 1999 GROUP BY 1)
        SELECT batch_id, rows_in, bad AS rows_quarantined, rows_in - bad AS rows_loaded, rows_in - bad AS rows_inserted, 0 AS rows_updated, 'OK' AS status FROM year"""
    out["file_outcomes"] = f"""WITH {BARS}, n AS (SELECT symbol, count(*) AS n FROM bars WHERE symbol NOT IN ('S3', 'S5', 'S7') GROUP BY 1)
        SELECT 'slot=' || s AS part, CASE WHEN n IS NOT NULL THEN 'loaded' WHEN s IN ('S3', 'S7') THEN 'empty'
            WHEN s = 'S5' THEN 'corrupt' ELSE 'missing' END AS status, coalesce(n, 0) AS row_count
          FROM (SELECT 'S' || s_suppkey AS s FROM supplier UNION ALL VALUES ('S-2'), ('S-1')) LEFT JOIN n ON s = symbol
        UNION ALL SELECT 'all', '', CAST(sum(n) AS BIGINT) FROM n"""
    hit = "trade_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-05'"
    late = "symbol = 'S1' AND trade_date >= DATE '2001-06-01'"
    out["summary_refresh"] = f"""WITH {TYPED}, corrected AS (SELECT * REPLACE (
          close_price + CASE WHEN {hit} THEN 1 ELSE 0 END AS close_price,
          volume + CASE WHEN {late} THEN 7 ELSE 0 END AS volume) FROM typed), {gold_ctes('corrected')},
        sectors AS (SELECT 'S' || s_suppkey AS supplier, r_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        joined AS (SELECT g.*, sector FROM gold g JOIN sectors ON symbol = supplier)
        SELECT * RENAME (exchange_code AS part) FROM ({summary('gold', AVG_VOL)})
        UNION ALL BY NAME SELECT * RENAME (sector AS part) FROM ({summary('joined', AVG_VOL, 'trade_date, sector')})"""
    out["watermark_table"] = f"""WITH {CONTRACT} SELECT symbol, exchange_code, max(trade_date) AS watermark FROM contract
        WHERE symbol IS NOT NULL AND trade_date IS NOT NULL GROUP BY 1, 2"""
    # A load reads what is new and what is still open: open days stay bad until given up or corrected.
    bad = "(CAST(substr(symbol, 2) AS BIGINT) * 31 + date_diff('day', DATE '1992-01-01', trade_date)) % 17 < 2"
    out["gap_watermarks"] = f"""WITH {FACT}, f AS (
          SELECT symbol, exchange_code, trade_date, {bad} AS bad, date_diff('day', DATE '1992-01-01', trade_date) % 2 = 0 AS stays,
            exchange_code = 'BSE' AND trade_date <= DATE '1997-12-31' AS given_up FROM fact WHERE trade_date < DATE '2001-01-01'),
        open AS (SELECT *, trade_date - CAST(row_number() OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date) AS INTEGER) AS island
          FROM f WHERE bad AND NOT (given_up AND trade_date < DATE '1999-01-01') AND stays),
        spans AS (SELECT symbol, exchange_code, CAST(min(trade_date) AS VARCHAR) || '/' || CAST(max(trade_date) AS VARCHAR) AS span
          FROM open GROUP BY symbol, exchange_code, island),
        gaps AS (SELECT symbol, exchange_code, string_agg(span, ',' ORDER BY span) AS gaps FROM spans GROUP BY 1, 2),
        marks AS (SELECT symbol, exchange_code, CAST(max(trade_date) AS VARCHAR) AS watermark FROM f GROUP BY 1, 2),
        runs AS (
          SELECT 'load 1997-01-01' AS symbol, count(*) AS rows_in, count(*) FILTER (WHERE bad) AS rows_quarantined FROM f WHERE trade_date < DATE '1997-01-01'
          UNION ALL
          SELECT 'load 1999-01-01', count(*), count(*) FILTER (WHERE bad) FROM f
            WHERE trade_date < DATE '1999-01-01' AND (trade_date >= DATE '1997-01-01' OR bad)
          UNION ALL
          SELECT 'load 2001-01-01', count(*), count(*) FILTER (WHERE bad AND stays) FROM f
            WHERE trade_date >= DATE '1999-01-01' OR (bad AND NOT given_up))
        SELECT symbol, exchange_code, watermark, coalesce(gaps, '') AS gaps, CAST(NULL AS BIGINT) AS rows_in, CAST(NULL AS BIGINT) AS rows_quarantined,
          CAST(NULL AS BIGINT) AS rows_updated FROM marks LEFT JOIN gaps USING (symbol, exchange_code)
        UNION ALL SELECT symbol, '', NULL, '', rows_in, rows_quarantined, 0 FROM runs"""
    totals = """count(*) AS rows_in, count(*) FILTER (WHERE violations <> '') AS rows_quarantined"""
    keys = "count(DISTINCT row(symbol, exchange_code, trade_date)) FILTER (WHERE violations = '')"
    out["run_metrics"] = f"""WITH {CONTRACT} SELECT 'run-1' AS batch_id, {totals}, {keys} AS rows_inserted, 0 AS rows_updated, 'OK' AS status FROM contract
        UNION ALL SELECT 'run-2', {totals}, 0, {keys}, 'OK' FROM contract"""
    out["medallion_clean"] = f"""WITH {CONTRACT}, clean_silver AS (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol, exchange_code, trade_date ORDER BY copy DESC) AS place
          FROM contract WHERE violations = '') WHERE place = 1), {gold_ctes('clean_silver')} {summary('gold', AVG_VOL)}"""
    out["q1_top_20"] = f"SELECT * FROM ({out['q1_price_stats']}) ORDER BY avg_close_price DESC NULLS LAST, symbol, exchange_code LIMIT 20"
    out["incremental_gold"] = out["gold_refresh"]
    day_over_day = f"""SELECT {KEY}, close_price, prev_close, close_price - prev_close AS daily_change,
        {pct('close_price', 'prev_close', 2)} AS daily_change_pct, nth FROM (
        SELECT *, lag(close_price) OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date) AS prev_close,
          row_number() OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date DESC) AS nth FROM typed)"""
    out["q3_day_over_day"] = f"WITH {TYPED} SELECT * EXCLUDE (nth) FROM ({day_over_day})"
    out["q3_latest_30"] = f"WITH {TYPED} SELECT * EXCLUDE (nth) FROM ({day_over_day}) WHERE nth <= 30"
    out["q4_latest_60"] = f"SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, exchange_code ORDER BY trade_date DESC) AS nth FROM ({out['q4_moving_averages']})) WHERE nth <= 60"
    one = "symbol = 'S1' AND exchange_code = 'NSE'"
    out["q3_one_listing"] = f"SELECT * FROM ({out['q3_latest_30']}) WHERE {one}"
    out["q4_one_listing"] = f"SELECT * FROM ({out['q4_latest_60']}) WHERE {one}"
    return out
