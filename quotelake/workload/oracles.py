"""ANSI SQL (as DuckDB runs it) for the registered queries, over the same tables.

Written apart from the Spark jobs: windows instead of aggregated structs, whole
numbers instead of DECIMAL rounding.
"""

from __future__ import annotations

# --- shared inputs ----------------------------------------------------------


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def dbl(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def big(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


# The events lie in January, when local market time is two hours ahead of UTC.
_STATE = """CASE WHEN dayofweek(ts + INTERVAL 2 HOUR) BETWEEN 0 AND 4
  AND CAST(ts + INTERVAL 2 HOUR AS TIME) BETWEEN TIME '10:00:00' AND TIME '14:30:00'
  THEN 'OPEN' ELSE 'CLOSED' END"""

_INPUTS = {
    "ticks": f"""SELECT (CASE WHEN event_type = 'signup' THEN 'EGX' ELSE 'S' END) || user_id AS ticker,
  'Company ' || user_id AS company_name, ts AS time,
  CAST(value AS DECIMAL(18,4)) AS price,
  CAST(value AS DECIMAL(18,4)) AS open,
  CAST(CAST(value AS DECIMAL(18,4)) + k AS DECIMAL(18,4)) AS high,
  CAST(CAST(value AS DECIMAL(18,4)) - 0.5 AS DECIMAL(18,4)) AS low,
  k AS volume,
  CAST(CAST(value AS DECIMAL(18,4)) - 2 * k AS DECIMAL(18,4)) AS price_change_percent,
  {_STATE} AS market_status
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "points": """SELECT ticker AS symbol, time, open, high, low, price AS close, volume FROM ticks""",
    "clock": "SELECT max(ts) AS now, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS midnight FROM events",
    "tick_bars": """SELECT ticker AS symbol, CAST(time AS DATE) AS trade_date,
  first(price ORDER BY time, price) AS open_price, max(price) AS high_price,
  min(price) AS low_price, last(price ORDER BY time, price) AS close_price,
  CAST(sum(volume) AS BIGINT) AS volume, 'STREAMING_API' AS data_source
  FROM ticks GROUP BY 1, 2""",
    "stock_price": """SELECT l_orderkey * 10 + l_linenumber AS price_id, l_partkey AS company_id,
  CAST(l_shipdate AS DATE) AS trade_date,
  CAST(l_extendedprice AS DECIMAL(18,4)) AS open_price,
  CAST(CAST(l_extendedprice AS DECIMAL(18,4)) + CAST(l_quantity AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS high_price,
  CAST(CAST(l_extendedprice AS DECIMAL(18,4)) - CAST(l_discount AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS low_price,
  CAST(CAST(l_extendedprice AS DECIMAL(18,4)) + CAST(l_tax AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS close_price,
  CAST(l_quantity AS BIGINT) AS volume, ' ' || lower(l_returnflag) || ' ' AS data_source,
  l_shipdate + l_suppkey * INTERVAL 1 DAY AS created_at
  FROM lineitem""",
    "latest_price": """SELECT * EXCLUDE (data_source), upper(trim(data_source)) AS data_source
  FROM stock_price
  QUALIFY row_number() OVER (PARTITION BY company_id, trade_date ORDER BY created_at DESC,
    price_id DESC, open_price DESC, high_price DESC, low_price DESC, close_price DESC,
    volume DESC, data_source DESC) = 1""",
    "part_prices": """SELECT 'P' || company_id AS symbol, trade_date, open_price, high_price,
  low_price, close_price, volume, data_source FROM latest_price""",
    "company": """SELECT p_partkey AS company_id, 'P' || p_partkey AS symbol, p_name AS company_name,
  CASE WHEN p_size > 10 THEN p_type END AS sector, p_brand AS industry,
  CAST(p_retailprice AS DECIMAL(20,2)) AS market_cap, CAST(NULL AS VARCHAR) AS logo_url,
  CASE WHEN p_size > 25 THEN 'Buy' END AS analyst_rating,
  CASE WHEN p_size > 10 THEN p_size < 40 END AS is_active,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-02 00:00:00' AS updated_at
  FROM part""",
    "idx": """SELECT DISTINCT CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS index_id,
  p_brand AS index_code, 'Index of ' || p_brand AS index_name, p_brand AS description,
  TRUE AS is_active FROM part""",
    "membership": """SELECT p_partkey AS membership_id,
  CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS index_id, p_partkey AS company_id,
  CASE WHEN p_size > 5 THEN CAST(p_size AS DECIMAL(8,4)) END AS weight,
  DATE '1995-01-01' + CAST(p_size * 20 AS INTEGER) AS effective_date, p_size < 45 AS is_current
  FROM part""",
    "members": """SELECT m.membership_id, m.index_id, i.index_code, i.index_name,
  i.description AS index_description, m.company_id, c.symbol, c.company_name, c.sector, m.weight,
  m.effective_date, m.is_current
  FROM membership m JOIN idx i USING (index_id) JOIN company c USING (company_id)
  WHERE m.is_current""",
    "market_stat": """SELECT o_orderkey AS stat_id, o_custkey AS company_id,
  o_orderdate AS snapshot_datetime, CAST(o_totalprice AS DECIMAL(18,4)) AS price,
  CAST(1.5 AS DECIMAL(8,4)) AS change_pct, o_orderkey AS volume,
  CAST(1 AS DECIMAL(10,2)) AS relative_volume, CAST(o_totalprice AS DECIMAL(20,2)) AS market_cap,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,4)) END AS pe_ratio,
  CAST(o_totalprice AS DECIMAL(18,4)) AS eps_ttm, CAST(0.5 AS DECIMAL(8,4)) AS eps_growth_yoy,
  CAST(2.25 AS DECIMAL(8,4)) AS div_yield_pct,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS sector,
  CASE WHEN o_orderstatus = 'O' THEN 'Sell' END AS analyst_rating, o_orderdate AS created_at
  FROM orders""",
    "stats": """SELECT m.stat_id, m.company_id, c.symbol, c.company_name, c.sector AS company_sector,
  m.snapshot_datetime, m.price, m.change_pct, m.volume, m.relative_volume, m.market_cap,
  m.pe_ratio, m.eps_ttm, m.eps_growth_yoy, m.div_yield_pct, m.sector AS market_sector,
  m.analyst_rating, coalesce(c.sector, m.sector) AS effective_sector, m.created_at AS ingested_at
  FROM market_stat m JOIN company c USING (company_id)""",
    "company_dimension": """SELECT c.company_id, c.symbol, c.company_name,
  coalesce(s.effective_sector, c.sector) AS sector, c.industry, s.price AS latest_price,
  s.change_pct AS latest_change_pct, s.market_cap, s.pe_ratio, s.eps_ttm, s.div_yield_pct,
  coalesce(s.analyst_rating, c.analyst_rating) AS analyst_rating, c.logo_url,
  p.latest_price_date, p.trading_days_available, c.is_active,
  s.snapshot_datetime AS latest_market_data_at, c.created_at AS ingested_at,
  c.updated_at AS company_last_updated
  FROM company c
  LEFT JOIN (SELECT symbol, max(trade_date) AS latest_price_date,
    count(DISTINCT trade_date) AS trading_days_available FROM part_prices GROUP BY 1) p
    ON c.symbol = p.symbol
  LEFT JOIN (SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY company_id
    ORDER BY snapshot_datetime DESC, stat_id DESC) = 1) s ON c.company_id = s.company_id""",
    "companies_raw": """SELECT 'S' || s_suppkey AS symbol,
  CASE WHEN s_acctbal > 0 THEN s_name END AS company_name,
  CASE WHEN s_nationkey < 12 THEN 'EGP' ELSE ' usd ' END AS currency,
  CASE WHEN load = 2 THEN ' Sector ' || n_regionkey END AS sector,
  CASE WHEN s_nationkey > 4 THEN n_name END AS industry, 'Head' AS ceo_name,
  CAST(NULL AS VARCHAR) AS website, n_name || ' - Block,' || s_nationkey AS headquarters,
  '1999' AS founded_date, 'EG' || s_suppkey AS isin,
  CAST(s_acctbal AS DECIMAL(18,2)) AS market_cap, CAST(NULL AS VARCHAR) AS logo_url,
  'companies/' || load AS file_name,
  TIMESTAMP '2024-02-01 00:00:00' + load * INTERVAL 1 DAY AS load_ts
  FROM supplier JOIN nation ON s_nationkey = n_nationkey, (VALUES (1), (2)) loads(load)""",
    "statements": """SELECT 'C' || o_custkey AS symbol,
  CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter,
  CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN a END) AS DOUBLE) AS total_revenue,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN a END) AS DOUBLE) AS gross_profit,
  CAST(sum(CASE WHEN o_orderstatus = 'O' THEN a END) AS DOUBLE) AS net_income,
  CAST(max(a) AS DOUBLE) AS eps, CAST(min(a) AS DOUBLE) AS operating_expense,
  CAST(sum(a) AS DOUBLE) AS total_assets,
  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN a END) AS DOUBLE) AS total_liabilities,
  CAST(count(*) AS DOUBLE) AS free_cash_flow
  FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS a FROM orders) GROUP BY 1, 2""",
    "order_text": """SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS kind,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS plain,
  'Q' || quarter(o_orderdate) || ' ''' || strftime(o_orderdate, '%y') AS quarter_text,
  make_date(2000 + CAST(strftime(o_orderdate, '%y') AS BIGINT), 3 * quarter(o_orderdate) - 2, 1)
    AS quarter_day FROM orders""",
    "listed": """SELECT DISTINCT 'P' || (l_partkey + l_linenumber) AS symbol FROM lineitem""",
}

_NEEDS = {
    "points": ["ticks"],
    "tick_bars": ["ticks"],
    "latest_price": ["stock_price"],
    "part_prices": ["latest_price"],
    "members": ["membership", "idx", "company"],
    "stats": ["market_stat", "company"],
    "company_dimension": ["company", "stats", "part_prices"],
}


def _gold(bars: str) -> dict[str, str]:
    """The gold fact in whole ten-thousandths, rounded half away from zero."""
    return {
        "bars": f"""SELECT symbol, trade_date, data_source, volume,
  CAST(open_price * 10000 AS HUGEINT) AS o4, CAST(high_price * 10000 AS HUGEINT) AS h4,
  CAST(low_price * 10000 AS HUGEINT) AS l4, CAST(close_price * 10000 AS HUGEINT) AS c4
  FROM {bars}""",
        "framed": """SELECT *, lag(c4) OVER w AS p4,
  sum(c4) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s7,
  count(*) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n7,
  sum(c4) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS s30,
  count(*) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS n30,
  CAST(sum(volume) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS HUGEINT) AS v7
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)""",
        "gold": """SELECT symbol, trade_date, CAST(o4 AS DOUBLE) / 10000 AS open_price,
  CAST(h4 AS DOUBLE) / 10000 AS high_price, CAST(l4 AS DOUBLE) / 10000 AS low_price,
  CAST(c4 AS DOUBLE) / 10000 AS close_price, volume,
  CAST(c4 - p4 AS DOUBLE) / 10000 AS price_change,
  CASE WHEN p4 <> 0 THEN CAST(CASE WHEN c4 < p4 THEN -1 ELSE 1 END
    * ((2 * abs(c4 - p4) * 1000000 + p4) // (2 * p4)) AS DOUBLE) / 10000 END AS price_change_pct,
  CAST(h4 - l4 AS DOUBLE) / 10000 AS price_range,
  CAST((2 * (h4 + l4 + c4) + 300) // 600 AS DOUBLE) / 100 AS typical_price,
  (2 * s7 + 100 * n7) // (200 * n7) AS m7, (2 * s30 + 100 * n30) // (200 * n30) AS m30,
  CAST((2 * s7 + 100 * n7) // (200 * n7) AS DOUBLE) / 100 AS ma_7d,
  CAST((2 * s30 + 100 * n30) // (200 * n30) AS DOUBLE) / 100 AS ma_30d,
  (2 * v7 + n7) // (2 * n7) AS vm7,
  CAST((2 * v7 + n7) // (2 * n7) AS DOUBLE) AS volume_ma_7d,
  CASE WHEN ma_7d > ma_30d AND c4 > 100 * m7 THEN 'BULLISH'
    WHEN ma_7d < ma_30d AND c4 < 100 * m7 THEN 'BEARISH' ELSE 'NEUTRAL' END AS trend_signal,
  CASE WHEN volume > volume_ma_7d * 1.5 THEN 'HIGH'
    WHEN volume < volume_ma_7d * 0.5 THEN 'LOW' ELSE 'NORMAL' END AS volume_signal,
  data_source FROM framed""",
    }


_GOLD_COLUMNS = f"""symbol, {day('trade_date')} AS trade_date, open_price, high_price, low_price,
  close_price, volume, price_change, price_change_pct, price_range, typical_price, ma_7d, ma_30d,
  volume_ma_7d, trend_signal, volume_signal, data_source"""


def sql(body: str, *inputs: str, **extra: str) -> str:
    """The body behind WITH clauses for the inputs it names and those they need."""
    clauses: dict[str, str] = {}

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        clauses.setdefault(name, _INPUTS[name])

    for name in inputs:
        add(name)
    clauses.update(extra)
    if not clauses:
        return body
    listed = ",\n".join(f"{name} AS ({text})" for name, text in clauses.items())
    return f"WITH {listed}\n{body}"


def gold(body: str, bars: str, *inputs: str, **extra: str) -> str:
    return sql(body, bars, *inputs, **_gold(bars), **extra)


def _full_gold(bars: str) -> str:
    return gold(f"SELECT {_GOLD_COLUMNS} FROM gold", bars)


_LATEST_GOLD = "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) = 1"

ORACLES: dict[str, str] = {}

# --- daily prices -----------------------------------------------------------

ORACLES["daily_prices_gold"] = _full_gold("part_prices")
ORACLES["daily_prices_sliced"] = _full_gold("part_prices")
ORACLES["daily_prices_ranged"] = _full_gold("part_prices")
ORACLES["daily_prices_stored"] = _full_gold("part_prices")
ORACLES["daily_prices_ticks"] = _full_gold("tick_bars")
ORACLES["daily_prices_incremental"] = gold(
    f"""SELECT {_GOLD_COLUMNS} FROM gold
    WHERE trade_date > (SELECT max(trade_date) FROM bars) - 5""",
    "tick_bars",
)
ORACLES["gold_incremental_run"] = _full_gold("part_prices")
ORACLES["top_movers"] = gold(
    f"""SELECT symbol, close_price, price_change, price_change_pct, volume, trend_signal,
    CASE WHEN price_change_pct > 0 THEN 'GAINER' WHEN price_change_pct < 0 THEN 'LOSER'
      ELSE 'UNCHANGED' END AS mover_type
    FROM (SELECT * FROM gold WHERE price_change_pct IS NOT NULL) {_LATEST_GOLD}""",
    "part_prices",
)
ORACLES["volume_leaders"] = gold(
    f"""SELECT symbol, close_price, volume, volume_ma_7d,
    CASE WHEN vm7 <> 0 THEN CAST((20000 * CAST(volume AS HUGEINT) + vm7) // (2 * vm7) AS DOUBLE)
      / 100 END AS volume_vs_avg_pct, volume_signal FROM gold {_LATEST_GOLD}""",
    "part_prices",
)
ORACLES["market_snapshot"] = gold(
    f"""SELECT g.symbol, d.company_name, d.sector, {day('g.trade_date')} AS trade_date,
    g.close_price AS current_price, g.price_change, g.price_change_pct, g.volume,
    g.high_price AS day_high, g.low_price AS day_low, g.ma_7d, g.ma_30d, g.trend_signal,
    g.volume_signal, CAST(d.pe_ratio AS DOUBLE) AS pe_ratio,
    CAST(d.market_cap AS DOUBLE) AS market_cap, d.analyst_rating, g.data_source
    FROM gold g JOIN company_dimension d ON g.symbol = d.symbol
    QUALIFY row_number() OVER (PARTITION BY g.symbol ORDER BY g.trade_date DESC) = 1""",
    "part_prices", "company_dimension",
)
ORACLES["price_history"] = gold(
    f"""SELECT symbol, {day('trade_date')} AS trade_date, open_price, high_price, low_price,
    close_price, volume, ma_7d, ma_30d, trend_signal, data_source FROM gold
    WHERE trade_date >= (SELECT CAST(max(trade_date) - INTERVAL 6 MONTH AS DATE) FROM bars)""",
    "part_prices",
)
ORACLES["dedup_latest_two_key"] = sql(
    f"""SELECT price_id, company_id, {day('trade_date')} AS trade_date,
    {dbl('open_price', 'high_price', 'low_price', 'close_price')}, volume, data_source,
    {ts('created_at')} AS created_at, CAST(year(trade_date) AS BIGINT) AS trade_year,
    CAST(month(trade_date) AS BIGINT) AS trade_month,
    strftime(trade_date, '%Y%m') AS trade_yearmonth FROM latest_price""",
    "latest_price",
)
_UNIFIED = f"""SELECT p.symbol, c.company_name, c.sector, {day('p.trade_date')} AS trade_date,
    CAST(coalesce(p.o, p.close_price) AS DOUBLE) AS open_price,
    CAST(p.high_price AS DOUBLE) AS high_price, CAST(p.low_price AS DOUBLE) AS low_price,
    CAST(p.close_price AS DOUBLE) AS close_price, coalesce(p.v, 0) AS volume,
    'BATCH_S3' AS data_source, {ts('p.created_at')} AS ingested_at
    FROM (SELECT *, 'P' || company_id AS symbol, CASE WHEN volume > 10 THEN open_price END AS o,
        CASE WHEN volume < 45 THEN volume END AS v FROM stock_price
      WHERE volume > 2 AND {{0}}
      QUALIFY row_number() OVER (PARTITION BY company_id, trade_date ORDER BY created_at DESC,
        o DESC NULLS LAST, high_price DESC, low_price DESC, close_price DESC,
        v DESC NULLS LAST) = 1) p
    LEFT JOIN company c ON p.symbol = c.symbol"""
ORACLES["unified_prices"] = sql(_UNIFIED.format("TRUE"), "stock_price", "company")
ORACLES["unified_prices_increment"] = sql(
    _UNIFIED.format(
        """created_at > (SELECT max(created_at) FROM stock_price
        WHERE created_at < TIMESTAMP '2001-01-01 00:00:00')"""
    ),
    "stock_price", "company",
)
_TEXT_PRICES = f"""SELECT 'P' || l_partkey AS symbol, CAST(l_shipdate AS DATE) AS date,
  CAST(l_extendedprice AS DECIMAL(18,4)) AS price, l_linenumber % 5 + 1 AS kind,
  CASE WHEN l_linenumber % 5 + 1 = 2 THEN -(l_linenumber + 0.5) ELSE l_linenumber + 0.5 END
    AS change_pct,
  CASE l_linenumber % 5 + 1 WHEN 1 THEN l_quantity * 1000000 WHEN 2 THEN l_quantity * 1000
    WHEN 3 THEN -l_quantity * 1000000000 WHEN 4 THEN NULL ELSE l_quantity END AS volume,
  'prices/' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS file_name
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
    ORDER BY l_linenumber DESC, l_orderkey DESC, price DESC, volume DESC NULLS LAST) = 1"""
ORACLES["price_text_clean"] = sql(
    f"""SELECT symbol, {day('date')} AS date, CAST(price AS DOUBLE) AS open,
    CASE WHEN kind <> 1 THEN CAST(price AS DOUBLE) END AS high, CAST(price AS DOUBLE) AS low,
    CAST(price AS DOUBLE) AS close, CAST(change_pct AS DOUBLE) AS change_pct,
    CAST(volume AS DOUBLE) AS volume, 'no' AS last_day_raw, file_name FROM cleaned""",
    cleaned=_TEXT_PRICES,
)
ORACLES["fact_surrogate_key"] = sql(
    f"""SELECT symbol, {day('date')} AS date, CAST(price AS DOUBLE) AS close,
    CAST(volume AS DOUBLE) AS volume, md5(symbol || '-' || {day('date')}) AS price_id
    FROM cleaned WHERE date IS NOT NULL""",
    cleaned=_TEXT_PRICES,
)

# --- indices ----------------------------------------------------------------

ORACLES["index_staging"] = sql("SELECT * FROM idx", "idx")
ORACLES["index_membership"] = sql(
    f"""SELECT * REPLACE (CAST(weight AS DOUBLE) AS weight, {day('effective_date')} AS effective_date)
    FROM members""",
    "members",
)
_INDEX_DAYS = {
    "days": """SELECT m.index_code, m.index_name, p.trade_date,
  sum(p.open_price * m.weight) AS index_open, max(p.high_price * m.weight) AS index_high,
  min(p.low_price * m.weight) AS index_low, sum(p.close_price * m.weight) AS index_close,
  sum(p.volume) AS total_volume, count(DISTINCT p.symbol) AS constituents_count
  FROM members m JOIN part_prices p ON m.symbol = p.symbol AND p.trade_date >= m.effective_date
  GROUP BY 1, 2, 3""",
    "changed": """SELECT *, lag(index_close) OVER (PARTITION BY index_code ORDER BY trade_date)
  AS prev_close FROM days""",
}
_INDEX = f"""SELECT index_code, index_name, {day('trade_date')} AS trade_date,
  {dbl('index_open', 'index_high', 'index_low', 'index_close')}, {big('total_volume',
  'constituents_count')}, CAST(prev_close AS DOUBLE) AS prev_close,
  CAST(index_close - prev_close AS DOUBLE) AS daily_change,
  CASE WHEN prev_close > 0 THEN CAST(index_close - prev_close AS DOUBLE)
    / CAST(prev_close AS DOUBLE) * 100 END AS daily_change_pct,
  CAST(index_high - index_low AS DOUBLE) AS intraday_range,
  CASE WHEN index_low > 0 THEN CAST(index_high - index_low AS DOUBLE)
    / CAST(index_low AS DOUBLE) * 100 END AS intraday_range_pct FROM changed"""
ORACLES["index_performance"] = sql(_INDEX, "members", "part_prices", **_INDEX_DAYS)
ORACLES["index_performance_incremental"] = sql(
    _INDEX + " WHERE trade_date > (SELECT max(trade_date) FROM part_prices) - 30",
    "members", "part_prices", **_INDEX_DAYS,
)
ORACLES["index_incremental_run"] = sql(_INDEX, "members", "part_prices", **_INDEX_DAYS)
ORACLES["member_counts"] = sql(
    """SELECT index_code, index_name, count(*) AS members FROM membership JOIN idx USING (index_id)
    WHERE is_current GROUP BY 1, 2""",
    "membership", "idx",
)
ORACLES["members_top_n"] = sql(
    """SELECT index_code, symbol, company_name FROM members
    QUALIFY row_number() OVER (PARTITION BY index_code ORDER BY symbol) <= 10""",
    "members",
)
ORACLES["last_index_rows"] = sql(
    f"""SELECT ticker, {ts('time')} AS time, CAST(price AS DOUBLE) AS price FROM ticks
    WHERE starts_with(ticker, 'EGX')
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY time DESC) <= 10""",
    "ticks",
)
ORACLES["equal_weight"] = sql(
    """SELECT CAST(2 AS BIGINT) AS index_id, c.company_id,
    CAST(CAST(100.0 / (SELECT count(*) FROM listed) AS DECIMAL(8,4)) AS DOUBLE) AS weight,
    '2024-01-01' AS effective_date, TRUE AS is_current
    FROM listed JOIN company c USING (symbol)""",
    "listed", "company",
)
ORACLES["derived_index_union"] = sql(
    """SELECT CAST(3 AS BIGINT) AS index_id, company_id, CAST(NULL AS DOUBLE) AS weight,
    '2024-01-01' AS effective_date, TRUE AS is_current FROM (
      SELECT company_id FROM listed JOIN company USING (symbol)
      UNION SELECT company_id FROM membership WHERE is_current)""",
    "listed", "company", "membership",
)
ORACLES["membership_table_runs"] = sql(
    """SELECT row_number() OVER (ORDER BY index_id, company_id) AS membership_id,
    CAST(index_id AS BIGINT) AS index_id, company_id,
    CASE WHEN index_id = 2 THEN
      CAST(CAST(100.0 / (SELECT count(*) FROM listed) AS DECIMAL(8,4)) AS DOUBLE) END AS weight,
    '2024-01-01' AS effective_date, TRUE AS is_current
    FROM listed JOIN company USING (symbol), range(1, 4) AS i(index_id)
    WHERE index_id > 1 OR length(symbol) < 4""",
    "listed", "company",
)
ORACLES["anti_unmatched"] = sql(
    "SELECT symbol FROM listed WHERE symbol NOT IN (SELECT symbol FROM company)",
    "listed", "company",
)

# --- companies --------------------------------------------------------------

ORACLES["staged_companies"] = sql(
    f"""SELECT symbol, coalesce(company_name, 'Unknown Company') AS company_name,
    coalesce(sector, 'Unclassified') AS sector, coalesce(CAST(market_cap AS DOUBLE), 0)
    AS market_cap, logo_url, {ts('load_ts')} AS created_at FROM companies_raw
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY load_ts DESC) = 1""",
    "companies_raw",
)
ORACLES["completed_companies"] = sql(
    f"""SELECT company_id, symbol, company_name, 'Unknown' AS currency,
    coalesce(sector, 'Unknown') AS sector, industry, 'Unknown' AS ceo_name, 'Unknown' AS website,
    'Unknown' AS headquarters, 'unknown' AS founded_date, 'Unknown' AS isin,
    'Unknown' AS logo_url, coalesce(is_active, FALSE) AS is_active,
    {ts('created_at')} AS created_at, {ts('updated_at')} AS updated_at FROM company""",
    "company",
)
ORACLES["json_extract"] = sql(
    f"""SELECT symbol, company_name, currency, sector, industry, ceo_name, website, headquarters,
    founded_date, isin, file_name, {ts('load_ts')} AS load_ts FROM companies_raw""",
    "companies_raw",
)
_STATS = f"""SELECT * REPLACE ({ts('snapshot_datetime')} AS snapshot_datetime,
    {ts('ingested_at')} AS ingested_at, {dbl('price', 'change_pct', 'relative_volume',
    'market_cap', 'pe_ratio', 'eps_ttm', 'eps_growth_yoy', 'div_yield_pct')}) FROM stats"""
ORACLES["market_stats"] = sql(_STATS, "stats")
ORACLES["market_stats_increment"] = sql(
    _STATS
    + """ WHERE stats.ingested_at > (SELECT max(created_at) FROM market_stat
    WHERE created_at < TIMESTAMP '2000-01-01 00:00:00')""",
    "stats",
)
ORACLES["market_stats_latest"] = sql(
    f"""SELECT company_id, {ts('snapshot_datetime')} AS snapshot_datetime, stat_id,
    CAST(price AS DOUBLE) AS price, sector, analyst_rating FROM market_stat
    QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY market_stat.snapshot_datetime DESC,
      stat_id DESC) = 1""",
    "market_stat",
)
ORACLES["company_dim"] = sql(
    f"""SELECT * REPLACE ({dbl('latest_price', 'latest_change_pct', 'market_cap', 'pe_ratio',
    'eps_ttm', 'div_yield_pct')}, {day('latest_price_date')} AS latest_price_date,
    {ts('latest_market_data_at')} AS latest_market_data_at, {ts('ingested_at')} AS ingested_at,
    {ts('company_last_updated')} AS company_last_updated) FROM company_dimension""",
    "company_dimension",
)
# Commas, periods and hyphens count as spaces.
_LOCATION = "upper(trim(regexp_replace(headquarters, '[-.,]', ' ', 'g')))"


def _dense(column: str, source: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY n) AS id, n FROM (
      SELECT DISTINCT upper(trim({column})) AS n FROM {source}
      WHERE {column} IS NOT NULL AND trim({column}) <> '')"""


_LOCATIONS = f"""SELECT row_number() OVER (ORDER BY n) AS id, n FROM (
  SELECT DISTINCT {_LOCATION} AS n FROM companies_raw WHERE trim(headquarters) <> '')"""
ORACLES["company_star"] = sql(
    f"""SELECT symbol, company_name, CAST(CASE upper(trim(currency)) WHEN 'EGP' THEN 1 WHEN 'USD'
    THEN 2 END AS BIGINT) AS currency_id, s.id AS sector_id, i.id AS industry_id,
    l.id AS location_id, ceo_name, website, founded_date, isin FROM companies_raw r
    LEFT JOIN sectors s ON upper(trim(r.sector)) = s.n
    LEFT JOIN industries i ON upper(trim(r.industry)) = i.n
    LEFT JOIN locations l ON {_LOCATION} = l.n""",
    "companies_raw",
    sectors=_dense("sector", "companies_raw"),
    industries=_dense("industry", "companies_raw"),
    locations=_LOCATIONS,
)
_UPDATES = """SELECT 'P' || (s_suppkey * 30) AS symbol, s_name AS company_name,
  CASE WHEN s_acctbal > 5000 THEN 'Banks' END AS sector,
  CAST(s_acctbal AS DECIMAL(20,2)) AS market_cap FROM supplier"""
ORACLES["merge_company"] = sql(
    """SELECT coalesce(c.company_id, (SELECT max(company_id) FROM company)
      + row_number() OVER (PARTITION BY c.company_id IS NULL ORDER BY u.symbol)) AS company_id,
    coalesce(c.symbol, u.symbol) AS symbol,
    CASE WHEN u.symbol IS NULL THEN c.company_name ELSE u.company_name END AS company_name,
    CASE WHEN u.symbol IS NULL THEN c.sector ELSE u.sector END AS sector,
    CAST(CASE WHEN u.symbol IS NULL THEN c.market_cap ELSE u.market_cap END AS DOUBLE)
      AS market_cap, c.industry,
    CASE WHEN c.symbol IS NULL THEN TRUE ELSE c.is_active END AS is_active,
    CASE WHEN c.symbol IS NULL THEN '2024-02-01' ELSE '2024-01-01' END || ' 00:00:00.000000'
      AS created_at
    FROM company c FULL JOIN updates u ON c.symbol = u.symbol""",
    "company",
    updates=_UPDATES,
)
ORACLES["company_ids_kept"] = sql(
    """SELECT coalesce(c.company_id, (SELECT max(company_id) FROM company)
      + row_number() OVER (PARTITION BY c.company_id IS NULL ORDER BY u.late, u.symbol))
      AS company_id,
    coalesce(c.symbol, u.symbol) AS symbol,
    coalesce(u.company_name, c.company_name) AS company_name
    FROM company c FULL JOIN updates u ON c.symbol = u.symbol""",
    "company",
    updates=_UPDATES.replace("SELECT", "SELECT s_suppkey % 3 <> 0 AS late,", 1),
)
ORACLES["merge_sector"] = sql(
    """SELECT c.company_id, c.symbol, coalesce(m.sector, c.sector) AS sector FROM company c
    LEFT JOIN (SELECT company_id, sector FROM market_stat WHERE sector IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY company_id
        ORDER BY snapshot_datetime DESC, sector DESC) = 1) m USING (company_id)""",
    "company", "market_stat",
)
ORACLES["semi_active"] = sql(
    """SELECT company_id, symbol FROM company WHERE company_id IN (
      SELECT company_id FROM stock_price UNION SELECT company_id FROM market_stat)""",
    "company", "stock_price", "market_stat",
)
ORACLES["price_load"] = sql(
    f"""SELECT c.company_id, {day('p.trade_date')} AS trade_date,
    CAST(CASE WHEN volume > 20 THEN p.open_price ELSE p.close_price END AS DOUBLE) AS open_price,
    CAST(p.close_price AS DOUBLE) AS high_price, CAST(p.close_price AS DOUBLE) AS low_price,
    CAST(p.close_price AS DOUBLE) AS close_price,
    CASE WHEN volume > 5 THEN volume ELSE 0 END AS volume, 'BATCH_S3' AS data_source
    FROM stock_price p JOIN company c ON c.company_id = p.company_id + p.volume""",
    "stock_price", "company",
)
ORACLES["price_table_runs"] = sql(
    f"""SELECT row_number() OVER (ORDER BY trade_date >= DATE '1998-01-01', company_id, trade_date)
      AS price_id, company_id, {day('trade_date')} AS trade_date,
    CAST(open_price AS DOUBLE) AS open_price, {dbl('close_price')},
    CAST(close_price AS DOUBLE) AS high_price, CAST(close_price AS DOUBLE) AS low_price, volume,
    CAST(NULL AS DOUBLE) AS change_pct, 'BATCH_S3' AS data_source,
    '2024-02-01 00:00:00.000000' AS created_at
    FROM (SELECT c.company_id, p.trade_date, p.close_price,
        CASE WHEN p.volume > 20 THEN p.open_price ELSE p.close_price END AS open_price,
        CASE WHEN p.volume > 5 THEN p.volume ELSE 0 END AS volume
      FROM stock_price p JOIN company c ON c.company_id = p.company_id + p.volume
      QUALIFY row_number() OVER (PARTITION BY c.company_id, p.trade_date
        ORDER BY p.close_price DESC, CASE WHEN p.volume > 5 THEN p.volume ELSE 0 END DESC,
          CASE WHEN p.volume > 20 THEN p.open_price ELSE p.close_price END DESC) = 1)""",
    "stock_price", "company",
)
ORACLES["market_stat_table_runs"] = sql(
    """SELECT row_number() OVER (ORDER BY loaded, c.company_id, CAST(plain AS DOUBLE), kind >= 3,
        CASE WHEN kind <> 5 THEN 1 ELSE 0 END, CASE WHEN kind <> 1 THEN 1 ELSE 0 END,
        o_orderpriority) AS stat_id,
    c.company_id, loaded AS snapshot_datetime, CAST(plain AS DOUBLE) AS price,
    CASE WHEN kind <> 5 THEN CAST(trunc(CAST(plain AS DOUBLE) * 1000::DOUBLE) AS BIGINT) END
      AS volume, o_orderpriority AS sector
    FROM order_text JOIN company c ON c.company_id = o_custkey,
      (VALUES ('2024-02-01 00:00:00.000000'), ('2024-02-02 00:00:00.000000')) AS runs(loaded)""",
    "order_text", "company",
)
ORACLES["market_stat_load"] = sql(
    """SELECT c.company_id, CAST(plain AS DOUBLE) AS price,
    CASE WHEN kind < 3 THEN -2.5::DOUBLE ELSE 2.5::DOUBLE END AS change_pct,
    CASE WHEN kind <> 5 THEN CAST(trunc(CAST(plain AS DOUBLE) * 1000::DOUBLE) AS BIGINT) END
      AS volume,
    1250.5::DOUBLE AS relative_volume,
    CAST(trunc(CAST(plain AS DOUBLE) * 1000000::DOUBLE) AS BIGINT) AS market_cap,
    CASE WHEN kind <> 1 THEN CAST(plain AS DOUBLE) END AS pe_ratio, CAST(NULL AS DOUBLE) AS eps_ttm,
    CAST(NULL AS DOUBLE) AS eps_growth_yoy, 3.25::DOUBLE AS div_yield_pct,
    o_orderpriority AS sector, CAST(NULL AS VARCHAR) AS analyst_rating
    FROM order_text JOIN company c ON c.company_id = o_custkey""",
    "order_text", "company",
)

# --- statements and text ----------------------------------------------------

_METRICS = ("total_revenue", "gross_profit", "net_income", "eps", "operating_expense",
            "total_assets", "total_liabilities", "free_cash_flow")


def _per(part: str, whole: str) -> str:
    """A part of a whole, null unless the whole is positive."""
    return f"{part} / nullif(greatest({whole}, 0), 0)"


_RATIOS = f"""coalesce({_per('coalesce(gross_profit, 0)', 'total_revenue')} * 100, 0)
      AS gross_margin_pct,
    {_per('net_income', 'total_revenue')} * 100 AS net_margin_pct,
    {_per('net_income', 'total_assets')} * 100 AS roa_pct,
    {_per('total_assets', 'total_liabilities')} AS debt_to_asset_ratio"""
ORACLES["financial_ratios"] = sql(
    f"""SELECT symbol, {day('quarter')} AS quarter, CAST(year(quarter) AS BIGINT) AS fiscal_year,
    CAST(quarter(quarter) AS BIGINT) AS fiscal_quarter,
    {', '.join(f'coalesce({m}, 0) AS {m}' for m in _METRICS)}, {_RATIOS} FROM (
    SELECT * FROM statements)""".replace("quarter(quarter)", "quarter(statements.quarter)")
    .replace("FROM (\n    SELECT * FROM statements)", "FROM statements"),
    "statements",
)
ORACLES["staged_financials"] = sql(
    f"""SELECT symbol, company_name, sector,
    {day("make_date(2000 + year(q) % 100, month(q), 1)")} AS quarter,
    CAST(year(q) AS BIGINT) AS fiscal_year, CAST(NULL AS BIGINT) AS fiscal_quarter,
    {', '.join(f'coalesce({m}, 0) AS {m}' for m in _METRICS)}, {_RATIOS} FROM (
      SELECT s.symbol, s.quarter AS q, total_revenue, gross_profit, net_income,
        CAST(NULL AS DOUBLE) AS eps, CAST(NULL AS DOUBLE) AS operating_expense, total_assets,
        total_liabilities, CAST(NULL AS DOUBLE) AS free_cash_flow, c_name AS company_name,
        c_mktsegment AS sector
      FROM statements s LEFT JOIN customer ON s.symbol = 'C' || c_custkey)""",
    "statements",
)


def _magnitude(kind: str, value: str = "plain") -> str:
    return f"""CAST(CASE {kind} WHEN 1 THEN CAST({value} AS DECIMAL(28,2)) * 1000000
      WHEN 2 THEN CAST({value} AS DECIMAL(28,2)) * 1000
      WHEN 3 THEN CAST({value} AS DECIMAL(28,2)) * -1000000000
      WHEN 4 THEN NULL ELSE CAST({value} AS DECIMAL(28,2)) END AS DOUBLE)"""


_LATEST_STATEMENT = ", ".join(f"{m} DESC NULLS LAST" for m in _METRICS)
ORACLES["staged_financials_text"] = sql(
    f"""SELECT symbol, company_name, sector, {day("q")} AS quarter,
    CAST(NULL AS BIGINT) AS fiscal_year, CAST(NULL AS BIGINT) AS fiscal_quarter,
    {', '.join(f'coalesce({m}, 0) AS {m}' for m in _METRICS)}, {_RATIOS} FROM (
      SELECT * FROM (SELECT 'C' || o_custkey AS symbol, quarter_day AS q, o_orderdate,
        {_magnitude('kind')} AS total_revenue, {_magnitude('(kind % 5 + 1)')} AS gross_profit,
        CAST(CAST(o_totalprice * 2 AS DECIMAL(28,2)) * 1000000 AS DOUBLE) AS net_income,
        CASE WHEN kind = 2 THEN -1 ELSE 1 END * (o_custkey + 0.25::DOUBLE) AS eps,
        {_magnitude('((kind + 1) % 5 + 1)')} AS operating_expense,
        {_magnitude('2')} AS total_assets,
        CASE WHEN kind <> 5 THEN {_magnitude('5')} END AS total_liabilities,
        CASE WHEN kind <> 3 THEN {_magnitude('kind')} END AS free_cash_flow,
        c_name AS company_name, c_mktsegment AS sector
        FROM order_text LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')
      QUALIFY row_number() OVER (PARTITION BY symbol, q
        ORDER BY o_orderdate DESC, {_LATEST_STATEMENT}) = 1)""",
    "order_text",
)
ORACLES["magnitude_parse"] = sql(
    f"""SELECT 'C' || o_custkey AS symbol,
    CASE WHEN o_orderstatus <> 'P' THEN {day('quarter_day')} END AS quarter_date,
    {_magnitude('kind')} AS total_revenue,
    CAST(CAST(o_totalprice * 2 AS DECIMAL(28,2)) * 1000000 AS DOUBLE) AS net_income,
    {_magnitude('(kind % 5 + 1)')} AS operating_expense, {_magnitude('2')} AS total_assets,
    CAST(NULL AS DOUBLE) AS total_liabilities,
    CASE WHEN kind <> 3 THEN {_magnitude('kind')} END AS free_cash_flow,
    CASE WHEN kind = 2 THEN -(o_custkey + 0.25::DOUBLE) ELSE o_custkey + 0.25::DOUBLE END AS eps,
    'finances/' || o_orderkey AS file_name FROM order_text""",
    "order_text",
)
ORACLES["financial_facts"] = sql(
    f"""SELECT 'C' || o_custkey AS symbol, {day('quarter_day')} AS quarter_date,
    {_magnitude('kind')} AS total_revenue, 'finances/' || o_orderkey AS file_name,
    md5('C' || o_custkey || '-' || {day('quarter_day')}) AS financial_id
    FROM order_text WHERE o_orderstatus <> 'P'""",
    "order_text",
)
ORACLES["trimmed_statements"] = sql(
    f"""SELECT o_custkey AS company_id, 'C' || o_custkey AS symbol, quarter_text AS raw_quarter,
    'Q' || quarter(o_orderdate) AS fiscal_quarter,
    2000 + CAST(strftime(o_orderdate, '%y') AS BIGINT) AS fiscal_year,
    {', '.join(f"o_orderstatus || '{m}' AS {m}" for m in _METRICS)} FROM order_text""",
    "order_text",
)
ORACLES["quarter_parse"] = sql(
    f"""SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN 'H1 ' || strftime(o_orderdate, '%y') ELSE quarter_text END
      AS quarter,
    CASE WHEN o_orderstatus <> 'P' THEN {day('quarter_day')} END AS quarter_date
    FROM order_text""",
    "order_text",
)
ORACLES["volume_parse"] = sql(
    """SELECT o_orderkey, CAST(CASE kind
      WHEN 1 THEN trunc(CAST(plain AS DOUBLE) * 1000000::DOUBLE)
      WHEN 2 THEN trunc(CAST(plain AS DOUBLE) * 1000::DOUBLE)
      WHEN 3 THEN trunc(CAST('1' || plain AS DOUBLE)) WHEN 4 THEN NULL
      ELSE trunc(CAST(plain AS DOUBLE) * 1000000000::DOUBLE) END AS BIGINT) AS volume,
    CASE kind WHEN 1 THEN CAST(plain AS DOUBLE) WHEN 2 THEN -CAST(plain AS DOUBLE)
      WHEN 3 THEN CAST('1' || plain AS DOUBLE) END AS number FROM order_text""",
    "order_text",
)
ORACLES["change_pct_parse"] = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
    l_partkey, CASE WHEN l_linenumber <> 3 THEN CASE WHEN l_returnflag = 'R' THEN
      CASE WHEN l_tax = 0 THEN 0::DOUBLE ELSE -l_tax END ELSE l_tax END END AS change_pct
    FROM lineitem"""
ORACLES["unit_convert"] = sql(
    """SELECT o_orderkey, CAST(CASE kind WHEN 1 THEN CAST(plain AS DECIMAL(28,2)) * 1000000000
      WHEN 2 THEN CAST(plain AS DECIMAL(28,2)) * 1000000
      WHEN 3 THEN CAST(plain AS DECIMAL(28,2)) * 1000
      WHEN 4 THEN CAST(plain AS DECIMAL(28,2)) END AS DOUBLE) AS value FROM order_text""",
    "order_text",
)

# --- dimensions -------------------------------------------------------------

ORACLES["dim_sector_dense"] = sql(
    "SELECT id AS sector_id, n AS sector_name FROM names",
    "companies_raw", names=_dense("sector", "companies_raw"),
)
ORACLES["dim_industry_dense"] = sql(
    "SELECT id AS industry_id, n AS industry_name FROM names", names=_dense("c_name", "customer")
)
ORACLES["dim_sector_hash"] = sql(
    """SELECT DISTINCT md5(coalesce(sector, 'Unknown')) AS sector_id,
    coalesce(sector, 'Unknown') AS sector FROM company""",
    "company",
)
ORACLES["dim_industry_hash"] = sql(
    "SELECT DISTINCT md5(industry) AS industry_id, industry FROM company", "company"
)
ORACLES["dim_location"] = sql(
    "SELECT id AS location_id, n AS location_name FROM names", "companies_raw", names=_LOCATIONS
)
ORACLES["dim_date"] = f"""SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, {day('d')} AS date,
    CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, CAST(day(d) AS BIGINT) AS day,
    CAST(weekofyear(d) AS BIGINT) AS week, CAST(quarter(d) AS BIGINT) AS quarter,
    strftime(d, '%Y-%m') AS year_month, year(d) || '-' || quarter(d) AS year_quarter,
    strftime(d, '%a') AS day_name, dayofweek(d) IN (5, 6) AS is_weekend,
    CAST(year(d + INTERVAL 6 MONTH) AS BIGINT) AS fiscal_year,
    CAST(1 + (quarter(d) + 2) % 4 AS BIGINT) AS fiscal_quarter,
    list_extract(['Winter', 'Spring', 'Summer', 'Autumn'], 1 + month(d) % 12 // 3) AS season
    FROM (SELECT unnest(generate_series(date_trunc('day', min(o_orderdate)),
      date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY)) AS d FROM orders)"""

# --- live panels ------------------------------------------------------------

_LATEST_TICK = "QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY ticks.time DESC) = 1"
_STOCK = "NOT starts_with(ticker, 'EGX')"

ORACLES["market_status_latest"] = sql(
    "SELECT market_status FROM ticks ORDER BY time DESC LIMIT 1", "ticks"
)
ORACLES["index_panel"] = sql(
    f"""SELECT CASE ticker WHEN 'EGX100' THEN 'EGX100 EWI' WHEN 'EGX33SHARIA' THEN 'EGX33 (Sharia)'
    ELSE ticker END AS "index", CAST(price AS DECIMAL(10,2)) || ' Points' AS value,
    CAST(CAST(price_change_percent AS DECIMAL(10,2)) AS DOUBLE) AS change_pct
    FROM ticks WHERE starts_with(ticker, 'EGX') {_LATEST_TICK}""",
    "ticks",
)
ORACLES["price_series_30m"] = sql(
    f"""SELECT {ts('time')} AS time, CAST(price AS DOUBLE) AS price, ticker AS metric FROM ticks
    WHERE ticks.time > (SELECT now FROM clock) - INTERVAL 30 MINUTE""",
    "ticks", "clock",
)
for _name, _order in (("gainers_top10", "DESC"), ("losers_top10", "ASC")):
    ORACLES[_name] = sql(
        f"""SELECT company_name, ticker, CAST(price AS DOUBLE) AS price,
        CAST(price_change_percent AS DOUBLE) AS price_change_percent
        FROM (SELECT * FROM ticks WHERE {_STOCK} {_LATEST_TICK}) l
        ORDER BY l.price_change_percent {_order} NULLS LAST, ticker LIMIT 10""",
        "ticks",
    )
ORACLES["volume_top10"] = sql(
    f"""SELECT company_name, volume FROM (SELECT * FROM ticks WHERE {_STOCK}
      AND time > (SELECT now FROM clock) - INTERVAL 6 HOUR {_LATEST_TICK})
    WHERE volume > 0 ORDER BY volume DESC, ticker LIMIT 10""",
    "ticks", "clock",
)
_FIVE = "FROM ticks WHERE time > (SELECT now FROM clock) - INTERVAL 5 MINUTE"
ORACLES["active_count_5m"] = sql(
    f"SELECT count(DISTINCT ticker) AS tickers {_FIVE}", "ticks", "clock"
)
ORACLES["avg_price_5m"] = sql(
    f"""SELECT CAST((2 * s * 10000 + n) // (2 * n) AS DOUBLE) / 100000000 AS avg_price
    FROM (SELECT CAST(sum(price) * 10000 AS HUGEINT) AS s, count(price) AS n {_FIVE})""",
    "ticks", "clock",
)
ORACLES["total_volume_5m"] = sql(
    f"SELECT CAST(sum(volume) AS BIGINT) AS total_volume {_FIVE}", "ticks", "clock"
)
_INDICES = "('EGX30', 'EGX30CAPPED', 'EGX70EWI', 'EGX100EWI')"


def _span(interval: str, stocks: bool = True) -> str:
    only = f" AND symbol NOT IN {_INDICES}" if stocks else ""
    return f"""FROM points WHERE points.time >= (SELECT midnight FROM clock) - INTERVAL {interval}
    AND points.time < (SELECT midnight FROM clock){only}"""


ORACLES["index_values_24h"] = sql(
    f"""SELECT symbol, {ts('time')} AS time, CAST(close AS DOUBLE) AS value
    {_span('30 DAY', False)} AND symbol IN {_INDICES}
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY points.time DESC) = 1""",
    "points", "clock",
)
ORACLES["volume_top10_24h"] = sql(
    f"""SELECT symbol, CAST(sum(volume) AS BIGINT) AS value {_span('24 HOUR')}
    GROUP BY symbol ORDER BY value DESC, symbol LIMIT 10""",
    "points", "clock",
)
# Written as the panel states it: all consecutive differences, summed up.
_NET = f"""SELECT symbol, CAST(sum(d) AS DOUBLE) AS value FROM (
  SELECT symbol, close - lag(close) OVER (PARTITION BY symbol ORDER BY time) AS d {_span('7 DAY')})
  WHERE d IS NOT NULL GROUP BY symbol"""
ORACLES["net_change_7d"] = sql(_NET, "points", "clock")
ORACLES["net_gainers_7d"] = sql(f"{_NET} ORDER BY value DESC, symbol LIMIT 5", "points", "clock")
ORACLES["net_losers_7d"] = sql(f"{_NET} ORDER BY value ASC, symbol LIMIT 5", "points", "clock")
ORACLES["volatility_7d"] = sql(
    f"""SELECT h.symbol, CAST(h.v - l.v AS DOUBLE) AS value
    FROM (SELECT symbol, max(high) AS v {_span('7 DAY')} GROUP BY 1) h
    JOIN (SELECT symbol, min(low) AS v {_span('7 DAY')} GROUP BY 1) l ON h.symbol = l.symbol
    ORDER BY value DESC, h.symbol LIMIT 10""",
    "points", "clock",
)
ORACLES["latest_pivot"] = sql(
    f"""SELECT symbol, {ts('time')} AS time, CAST(close AS DOUBLE) AS close,
    CAST(volume AS DOUBLE) AS volume {_span('24 HOUR')}
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY points.time DESC) = 1""",
    "points", "clock",
)
ORACLES["daily_last_downsample"] = sql(
    f"""SELECT symbol, {ts("date_trunc('day', points.time) + INTERVAL 1 DAY")} AS time,
    CAST(close AS DOUBLE) AS value {_span('5 YEAR', False)}
    QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('day', points.time)
      ORDER BY points.time DESC) = 1""",
    "points", "clock",
)
ORACLES["volume_share_24h"] = sql(
    f"""SELECT symbol, CAST(v AS BIGINT) AS value,
    CAST(v AS DOUBLE) / CAST(sum(v) OVER () AS DOUBLE) * 100 AS share_pct
    FROM (SELECT symbol, sum(volume) AS v {_span('24 HOUR')} GROUP BY symbol)""",
    "points", "clock",
)
ORACLES["consecutive_difference"] = sql(
    f"""SELECT ticker, {ts('t')} AS time, CAST(price AS DOUBLE) AS price,
    CAST(price - before AS DOUBLE) AS difference FROM (SELECT ticker, time AS t, price,
      lag(price) OVER (PARTITION BY ticker ORDER BY time) AS before FROM ticks)
    WHERE before IS NOT NULL""",
    "ticks",
)
ORACLES["market_hours"] = f"""SELECT {_STATE} AS state, CAST(hour(ts) AS BIGINT) AS utc_hour,
    count(*) AS ticks FROM events GROUP BY 1, 2"""

# --- quality ----------------------------------------------------------------

_LAST_DAY = """WHERE CAST(created_at AS DATE) =
    (SELECT max(CAST(created_at AS DATE)) FROM stock_price)"""
ORACLES["load_verify"] = sql(
    f"""SELECT upper(trim(data_source)) AS source, count(*) AS records,
    count(DISTINCT company_id) AS symbols FROM stock_price {_LAST_DAY} GROUP BY 1""",
    "stock_price",
)
ORACLES["ohlc_quality"] = sql(
    f"""SELECT 'ohlc_gate' AS "check", 'prices' AS "table", c AS "column", 'error' AS severity,
    f AS failures FROM (
      SELECT 'high' AS c, count(*) FILTER (WHERE high_price - volume * 2 < low_price) AS f
        FROM stock_price {_LAST_DAY}
      UNION ALL SELECT 'close', count(*) FILTER (WHERE volume >= 40)
        FROM stock_price {_LAST_DAY})""",
    "stock_price",
)
ORACLES["freshness"] = sql(
    f"""SELECT count(*) AS records, count(DISTINCT ticker) AS companies,
    {ts('max(time)')} AS latest FROM ticks
    WHERE time > (SELECT now FROM clock) - INTERVAL 24 HOUR""",
    "ticks", "clock",
)
ORACLES["dq_report"] = sql(
    """SELECT "check", "table", "column", severity, CAST(failures AS BIGINT) AS failures FROM (
    SELECT 'not_null' AS "check", 'company' AS "table", 'symbol' AS "column",
      'error' AS severity, count(*) FILTER (WHERE symbol IS NULL) AS failures FROM company
    UNION ALL SELECT 'not_null', 'company', 'sector', 'error',
      count(*) FILTER (WHERE sector IS NULL) FROM company
    UNION ALL SELECT 'not_null', 'company', 'is_active', 'error',
      count(*) FILTER (WHERE is_active IS NULL) FROM company
    UNION ALL SELECT 'unique', 'company', 'symbol', 'error', count(*) FROM
      (SELECT symbol FROM company GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'unique', 'stock_price', 'company_id,trade_date', 'error', count(*) FROM
      (SELECT company_id, trade_date FROM stock_price GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'accepted_values', 'market_stat', 'sector', 'warn',
      count(*) FROM market_stat WHERE sector NOT IN ('1-URGENT', '2-HIGH')
    UNION ALL SELECT 'relationships', 'market_stat', 'company_id', 'warn', count(*)
      FROM market_stat WHERE company_id NOT IN (SELECT company_id FROM company)
    UNION ALL SELECT 'relationships', 'stock_price', 'company_id', 'error', count(*)
      FROM stock_price WHERE company_id NOT IN (SELECT company_id FROM company)
    UNION ALL SELECT 'expression_is_true', 'stock_price', 'open_price', 'error', count(*)
      FROM stock_price WHERE NOT open_price >= 1000
    UNION ALL SELECT 'minimum_rows', 'stock_price', 'rows', 'error',
      greatest(100 - count(*), 0) FROM stock_price
    UNION ALL SELECT 'freshness', 'ticks', 'time', 'error',
      CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM ticks
      WHERE time > (SELECT now FROM clock) - INTERVAL 1 HOUR)""",
    "company", "market_stat", "stock_price", "ticks", "clock",
)
ORACLES["gold_checks"] = gold(
    """SELECT "check", 'gold_daily_prices' AS "table", "column", severity,
      CAST(failures AS BIGINT) AS failures FROM (
    SELECT 'not_null' AS "check", 'symbol' AS "column", 'error' AS severity,
      count(*) FILTER (WHERE symbol IS NULL) AS failures FROM gold
    UNION ALL SELECT 'not_null', 'trade_date', 'error',
      count(*) FILTER (WHERE trade_date IS NULL) FROM gold
    UNION ALL SELECT 'not_null', 'close_price', 'error',
      count(*) FILTER (WHERE close_price IS NULL) FROM gold
    UNION ALL SELECT 'not_null', 'price_change', 'error',
      count(*) FILTER (WHERE price_change IS NULL) FROM gold
    UNION ALL SELECT 'unique', 'symbol,trade_date', 'error', count(*) FROM
      (SELECT symbol, trade_date FROM gold GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'accepted_values', 'trend_signal', 'error', count(*) FROM gold
      WHERE trend_signal NOT IN ('BULLISH', 'BEARISH', 'NEUTRAL')
    UNION ALL SELECT 'accepted_values', 'volume_signal', 'error', count(*) FROM gold
      WHERE volume_signal NOT IN ('HIGH', 'NORMAL', 'LOW')
    UNION ALL SELECT 'accepted_values', 'data_source', 'warn', count(*) FROM gold
      WHERE data_source NOT IN ('A', 'N')
    UNION ALL SELECT 'relationships', 'trade_date', 'error', count(*) FROM gold
      WHERE trade_date NOT BETWEEN (SELECT min(l_shipdate) FROM lineitem)
        AND (SELECT max(l_shipdate) FROM lineitem)
    UNION ALL SELECT 'expression_is_true', 'volume', 'error', count(*) FROM gold
      WHERE NOT volume >= 0)""",
    "part_prices",
)


def _checked(table: str, source: str, *rows: tuple[str, str, str, str]) -> list[str]:
    """Selects of (check, column, severity, condition of a failing row) over one table."""
    return [
        f"""SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column",
        '{severity}' AS severity, count(*) FILTER (WHERE {failing}) AS failures FROM {source}"""
        for check, column, severity, failing in rows
    ]


def _null(*columns: str, severity: str = "error"):
    return [("not_null", c, severity, f"{c} IS NULL") for c in columns]


def _repeated(table: str, source: str, key: str) -> str:
    return f"""SELECT 'unique' AS "check", '{table}' AS "table", '{key}' AS "column",
    'error' AS severity, count(*) AS failures FROM (SELECT {key} FROM {source}
      WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"""


def _of(name: str) -> str:
    return f"({ORACLES[name]}) AS t"


ORACLES["gold_table_checks"] = " UNION ALL ".join(
    [
        *_checked("gold_dim_company", _of("company_dim"),
                  *_null("company_id", "symbol", "company_name", "sector")),
        *[_repeated("gold_dim_company", _of("company_dim"), k) for k in ("company_id", "symbol")],
        *_checked("gold_fct_index_performance", _of("index_performance"),
                  *_null("index_code", "trade_date"),
                  *_null("prev_close", "index_open", severity="warn")),
        *_checked("dim_date", _of("dim_date"), *_null("date")),
        _repeated("dim_date", _of("dim_date"), "date"),
        *[
            part
            for name in ("sector", "industry")
            for part in (
                *_checked(f"dim_{name}", _of(f"dim_{name}_hash"), *_null(f"{name}_id", name)),
                _repeated(f"dim_{name}", _of(f"dim_{name}_hash"), f"{name}_id"),
            )
        ],
        *_checked("fct_financials", _of("financial_facts"),
                  *_null("financial_id", "symbol", "quarter_date", "total_revenue"),
                  ("expression_is_true", "total_revenue", "error", "NOT total_revenue >= 0"),
                  ("relationships", "symbol", "error", """symbol NOT IN
                    (SELECT 'C' || c_custkey FROM customer WHERE c_acctbal > 0)"""),
                  ("relationships", "quarter_date", "warn", """quarter_date NOT IN
                    (SELECT strftime(unnest(generate_series(date_trunc('day', min(o_orderdate)),
                      date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY)), '%Y-%m-%d')
                     FROM orders)""")),
        _repeated("fct_financials", _of("financial_facts"), "financial_id"),
    ]
)
ORACLES["row_counts"] = """SELECT 'company' AS table_name, count(*) AS rows FROM part
    UNION ALL SELECT 'market_stat', count(*) FROM orders
    UNION ALL SELECT 'stock_price', count(*) FROM lineitem
    UNION ALL SELECT 'ticks', count(*) FROM events"""
ORACLES["sector_coverage"] = sql(
    """SELECT count(*) AS rows, count(sector) AS filled,
    100.0::DOUBLE * count(sector) / count(*) AS pct FROM company""",
    "company",
)
ORACLES["orphan_report"] = sql(
    """SELECT count(*) AS orphans FROM market_stat
    WHERE company_id NOT IN (SELECT company_id FROM company)""",
    "market_stat", "company",
)

# --- incremental ------------------------------------------------------------

ORACLES["watermark_filter"] = sql(
    f"""SELECT stat_id, {ts('created_at')} AS created_at FROM market_stat
    WHERE market_stat.created_at > (SELECT max(created_at) FROM market_stat
      WHERE created_at < TIMESTAMP '2001-01-01 00:00:00')""",
    "market_stat",
)
ORACLES["latest_load_day"] = sql(
    f"""SELECT price_id, company_id, {ts('created_at')} AS created_at FROM stock_price
    WHERE CAST(stock_price.created_at AS DATE) =
      (SELECT max(CAST(created_at AS DATE)) FROM stock_price)""",
    "stock_price",
)
ORACLES["merge_prices"] = sql(
    f"""SELECT company_id, {day('trade_date')} AS trade_date,
    CAST(CASE WHEN volume > 25 THEN close_price * 2 ELSE close_price END AS DOUBLE) AS close_price,
    volume FROM latest_price""",
    "latest_price",
)
ORACLES["archive_split"] = sql(
    f"""SELECT CASE WHEN old THEN 'archived' ELSE 'kept' END AS side, count(*) AS rows,
    {day('min(trade_date)')} AS first, {day('max(trade_date)')} AS last FROM (
      SELECT *, trade_date < (SELECT max(trade_date) FROM stock_price) - 360 AS old
      FROM stock_price) GROUP BY old""",
    "stock_price",
)
ORACLES["archive_repeated"] = sql(
    f"""SELECT symbol, {day('trade_date')} AS trade_date, volume,
    CASE WHEN trade_date < (SELECT max(trade_date) FROM tick_bars) - 8 THEN 'archived'
      ELSE 'live' END AS side FROM tick_bars""",
    "tick_bars",
)
ORACLES["schema_sync"] = sql(
    """SELECT company_id, symbol, CAST(NULL AS DOUBLE) AS balance FROM company
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
    "company",
)
ORACLES["partition_upsert"] = sql(
    f"""SELECT company_id, {day('trade_date')} AS trade_date, volume,
    CAST(CASE WHEN latest_price.trade_date >= DATE '2001-01-01' AND volume > 25
      THEN close_price + 1 ELSE close_price END AS DOUBLE) AS close_price FROM latest_price""",
    "latest_price",
)

# --- sources ----------------------------------------------------------------

ORACLES["bar_messages"] = sql(
    f"""SELECT symbol, {day('trade_date')} || 'T16:00:00' AS datetime,
    CAST(open_price AS DOUBLE) AS open, CAST(high_price AS DOUBLE) AS high,
    CAST(low_price AS DOUBLE) AS low, CAST(close_price AS DOUBLE) AS close, volume,
    CAST(close_price AS DOUBLE) AS adjusted_close, 'Daily' AS "interval", 'EGX' AS exchange,
    'EODHD' AS data_source, '2024-02-01T00:00:00' AS ingestion_timestamp FROM tick_bars""",
    "tick_bars",
)
ORACLES["tagged_points"] = f"""SELECT
    CASE WHEN event_type = 'error' THEN 'UNKNOWN' ELSE 'S' || user_id END AS symbol,
    'EGX' AS exchange, 'Daily' AS "interval", 0::DOUBLE AS open, 0::DOUBLE AS high,
    0::DOUBLE AS low, CASE WHEN event_type = 'view' THEN 0 ELSE value END AS close,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume,
    {ts("CASE WHEN event_type = 'click' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ts END")} AS time
    FROM events"""
ORACLES["first_links"] = """SELECT event_id AS position, event_type AS text,
    '/symbols/' || user_id AS url FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1"""
# Arrays of n quarters keep their last eight; values pair with them from the first on.
ORACLES["statement_rows"] = f"""SELECT symbol, 'Q' || (i + greatest(n - 8, 0)) AS quarter,
    CASE WHEN i <> 2 THEN CAST(i + p_size AS VARCHAR) END AS net_income,
    CAST(NULL AS VARCHAR) AS eps FROM (
      SELECT 'P' || p_partkey AS symbol, p_size, p_size % 11 + 1 AS n,
        unnest(generate_series(1, least(p_size % 11 + 1, 8))) AS i FROM part)"""
ORACLES["route_files"] = """SELECT p_partkey, path, CASE
    WHEN contains(lower(path), 'company') OR contains(lower(path), 'list') THEN 'company'
    WHEN contains(lower(path), 'price') OR contains(lower(path), 'ohlc') THEN 'stock_price'
    WHEN contains(lower(path), 'financial') THEN 'financial' END AS target
    FROM (SELECT p_partkey, replace(replace(replace('batch/' || p_type || '/' || p_name || '.csv',
      'PROMO', 'Company'), 'SMALL', 'OHLC'), 'LARGE', 'Financials') AS path FROM part)"""
_LOADS = [f"'2024-02-0{day} 00:00:00.000000'" for day in (1, 2, 3)]

ORACLES["bronze_load"] = f"""SELECT s_suppkey, s_name, s_acctbal, CAST(NULL AS VARCHAR) AS absent,
    'S' || (s_suppkey % 10) AS _ingest_symbol, {_LOADS[0]} AS load_ts FROM supplier"""
ORACLES["bronze_prices"] = f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
    l_extendedprice, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity,
    'P' || (l_partkey % 40) AS _ingest_symbol, {_LOADS[0]} AS load_ts FROM lineitem"""
ORACLES["bronze_statements"] = f"""SELECT o_orderkey, o_totalprice,
    CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus,
    'C' || (o_custkey % 30) AS _ingest_symbol, {_LOADS[0]} AS load_ts FROM orders"""
ORACLES["bronze_companies"] = f"""WITH named AS (
    SELECT CASE WHEN p_size % 2 = 0 THEN ' p' ELSE 'C' END || (p_partkey % 60) || ' ' AS "Symbol",
        p_partkey, p_name FROM part
), known AS (
    SELECT 'P' || (l_partkey % 40) AS symbol FROM lineitem
    UNION SELECT 'C' || (o_custkey % 30) FROM orders WHERE o_custkey % 30 < 12
)
SELECT "Symbol", p_partkey, p_name, CAST(NULL AS VARCHAR) AS _ingest_symbol,
    {_LOADS[0]} AS load_ts
FROM named WHERE upper(trim("Symbol")) IN (SELECT symbol FROM known)"""
ORACLES["bronze_second_run"] = f"""SELECT o_orderkey, 'C' || (o_custkey % 30) AS _ingest_symbol,
    CASE WHEN o_custkey % 30 < 18 THEN {_LOADS[0]} ELSE {_LOADS[1]} END AS load_ts FROM orders"""
ORACLES["bronze_full_refresh"] = f"""SELECT o_orderkey, 'C' || (o_custkey % 30) AS _ingest_symbol,
    {_LOADS[2]} AS load_ts FROM orders"""
# A file per symbol, and with each of the first two runs one of no bytes and one without rows.
ORACLES["bronze_status"] = """WITH noted AS (
    SELECT DISTINCT CAST(o_custkey % 30 >= 18 AS INT) AS run, o_custkey % 30 AS file FROM orders
    UNION ALL SELECT run, -kind FROM range(0, 2) AS r(run), range(1, 3) AS k(kind)
) SELECT CASE WHEN noted.run <> seen.run THEN 'skipped' WHEN file < 0 THEN 'empty'
      ELSE 'processed' END AS status, count(*) AS files, seen.run AS run
    FROM noted, range(0, 3) AS seen(run) GROUP BY 1, 3"""
_DROPPED = """SELECT 'P' || (company_id + volume) AS symbol, volume, close_price,
    CASE WHEN volume <> 7 THEN trade_date END AS trade_date FROM stock_price"""
ORACLES["batch_job_report"] = sql(
    """SELECT 'company_list.csv' AS file_name, 'company' AS target, 'loaded' AS status,
      count(*) AS rows, CAST(0 AS BIGINT) AS rejected FROM part
    UNION ALL SELECT 'ohlc' || volume % 5 || '.csv', 'stock_price',
      CASE WHEN volume % 5 = 3 THEN 'missing columns' ELSE 'loaded' END, count(*),
      CASE WHEN volume % 5 = 3 THEN 0 ELSE count(*) FILTER (WHERE trade_date IS NULL) END
      FROM dropped WHERE volume % 5 < 4 GROUP BY volume % 5
    UNION ALL SELECT 'notes.csv', NULL, 'no table', count(*), 0 FROM dropped
      WHERE volume % 5 = 4 HAVING count(*) > 0""",
    "stock_price", dropped=_DROPPED,
)
ORACLES["batch_job_prices"] = sql(
    f"""SELECT row_number() OVER (ORDER BY company_id, trade_date) AS price_id, company_id, symbol,
    sector, {day('trade_date')} AS trade_date, {dbl('close_price')}, volume FROM (
      SELECT d.*, company_id, sector FROM dropped d JOIN (
        SELECT 'P' || p_partkey AS symbol, CASE WHEN p_size > 10 THEN p_type END AS sector,
          row_number() OVER (ORDER BY 'P' || p_partkey) AS company_id FROM part) USING (symbol)
      WHERE volume % 5 < 3 AND trade_date IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY company_id, trade_date
        ORDER BY close_price DESC, volume DESC) = 1)""",
    "stock_price", dropped=_DROPPED,
)
# A line per order and a header per file; every line ends with one byte.
ORACLES["file_inventory"] = """SELECT prefix, CAST(count(*) AS BIGINT) AS files,
    CAST(sum(size) AS BIGINT) AS bytes, 'csv' AS extensions,
    array_to_string(list_slice(list_sort(list(name)), 1, 5), ',') AS sample
    FROM (SELECT o_orderstatus AS prefix, 'C' || (o_custkey % 8) || '.csv' AS name,
        length('o_orderkey,o_custkey') + 1
          + sum(length(o_orderkey::VARCHAR) + length(o_custkey::VARCHAR) + 2) AS size
      FROM orders GROUP BY 1, 2) GROUP BY prefix"""
ORACLES["expected_folders"] = """SELECT prefix, count(file) AS files, count(file) > 0 AS found
    FROM (VALUES ('F'), ('O'), ('P'), ('TVH')) AS e(prefix)
    LEFT JOIN (SELECT DISTINCT o_orderstatus, o_custkey % 8 AS file FROM orders)
      ON o_orderstatus = prefix GROUP BY prefix"""
ORACLES["recent_file_rows"] = """SELECT o_orderkey, o_totalprice, 'C' || (o_custkey % 8) AS symbol
    FROM orders WHERE o_custkey % 8 > 2"""
ORACLES["materialize_incremental"] = sql(
    """SELECT company_id, symbol, CASE WHEN company_id >= 500 THEN 'Updated' ELSE sector END
    AS sector FROM company""",
    "company",
)

# --- streams ----------------------------------------------------------------

ORACLES["stream_ticks"] = sql(
    f"""SELECT ticker, {ts('time')} AS time, CAST(price AS DOUBLE) AS price, volume, market_status,
    {day('ticks.time')} AS trade_date FROM ticks""",
    "ticks",
)
ORACLES["stream_days_closed"] = ORACLES["stream_ticks"]
_WINDOWS = """SELECT ticker, price, volume, unnest([time_bucket(INTERVAL 30 MINUTE, time),
  time_bucket(INTERVAL 30 MINUTE, time) - INTERVAL 30 MINUTE]) AS start FROM ticks"""
_ROLLING = f"""SELECT {ts('start')} AS window_start, {ts('start + INTERVAL 1 HOUR')} AS window_end,
    count(DISTINCT ticker) AS tickers, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
    CAST(sum(volume) AS BIGINT) AS total_volume FROM windows"""
ORACLES["rolling_statistics"] = sql(f"{_ROLLING} GROUP BY start", "ticks", windows=_WINDOWS)
ORACLES["stream_live_stats"] = sql(
    f"""{_ROLLING} WHERE start + INTERVAL 1 HOUR <= (SELECT now FROM clock) - INTERVAL 5 MINUTE
    GROUP BY start""",
    "ticks", "clock", windows=_WINDOWS,
)
ORACLES["stream_latest"] = sql(
    f"""SELECT ticker, {ts('time')} AS time, CAST(price AS DOUBLE) AS price,
    CAST(price_change_percent AS DOUBLE) AS price_change_percent, volume FROM ticks {_LATEST_TICK}""",
    "ticks",
)
