"""Schemas of the tables and messages the jobs read and write."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_JSON_NAMES = {"int": "integer", "bigint": "long"}


def _schema(columns: str) -> T.StructType:
    """Columns as ``name type``; unlike Spark's own DDL reader it needs no session."""
    fields = re.findall(r"(`[^`]+`|\w+)\s+(\w+(?:\(\d+,\d+\))?)", columns)
    return T.StructType.fromJson(
        {
            "fields": [
                {"name": n.strip("`"), "type": _JSON_NAMES.get(t, t), "nullable": True,
                 "metadata": {}}
                for n, t in fields
            ]
        }
    )


BRONZE = _schema("file_name string, load_ts timestamp, raw variant")

COMPANY = _schema(
    "company_id int, symbol string, company_name string, sector string, industry string,"
    " market_cap decimal(20,2), logo_url string, analyst_rating string, is_active boolean,"
    " created_at timestamp_ntz, updated_at timestamp_ntz"
)
INDEX = _schema(
    "index_id int, index_code string, index_name string, description string, is_active boolean"
)
INDEX_MEMBERSHIP = _schema(
    "membership_id int, index_id int, company_id int, weight decimal(8,4),"
    " effective_date date, is_current boolean"
)
STOCK_PRICE = _schema(
    "price_id bigint, company_id int, trade_date date, open_price decimal(18,4),"
    " high_price decimal(18,4), low_price decimal(18,4), close_price decimal(18,4),"
    " volume bigint, change_pct decimal(8,4), data_source string, created_at timestamp_ntz"
)
FINANCIAL = _schema(
    "financial_id bigint, company_id int, quarter string, fiscal_year int, fiscal_quarter int,"
    " total_revenue decimal(20,2), gross_profit decimal(20,2), net_income decimal(20,2),"
    " operating_expense decimal(20,2), total_assets decimal(20,2),"
    " total_liabilities decimal(20,2), free_cash_flow decimal(20,2), eps decimal(18,4),"
    " created_at timestamp_ntz"
)
MARKET_STAT = _schema(
    "stat_id bigint, company_id int, snapshot_datetime timestamp_ntz, price decimal(18,4),"
    " change_pct decimal(8,4), volume bigint, relative_volume decimal(10,2),"
    " market_cap decimal(20,2), pe_ratio decimal(10,4), eps_ttm decimal(18,4),"
    " eps_growth_yoy decimal(8,4), div_yield_pct decimal(8,4), sector string,"
    " analyst_rating string, created_at timestamp_ntz"
)

# Landing tables: every value is text except the load and snapshot times.
LANDING_PRICES = _schema(
    "symbol string, trade_date string, open_price string, high_price string, low_price string,"
    " close_price string, change string, volume string, last_day string, loaded_at timestamp_ntz"
)
LANDING_INDEX_PRICES = _schema(
    "trade_date string, price string, open_price string, high_price string, low_price string,"
    " volume string, change_pct string, symbol string, loaded_at timestamp_ntz"
)
LANDING_FINANCIALS = _schema(
    "symbol string, row_num string, quarter string, total_revenue string, gross_profit string,"
    " net_income string, eps string, operating_expense string, total_assets string,"
    " total_liabilities string, free_cash_flow string, loaded_at timestamp_ntz"
)
LANDING_MARKET = _schema(
    "symbol string, price string, change_pct string, volume string, rel_volume string,"
    " market_cap string, pe_ratio string, eps_ttm string, eps_growth string, div_yield string,"
    " sector string, analyst_rating string, snapshot_datetime timestamp_ntz,"
    " loaded_at timestamp_ntz"
)

# JSON tick message as it arrives on the stream; `timestamp` is ISO-8601 text.
TICK_MESSAGE = _schema(
    "ticker string, company_name string, price double, open double, high double, low double,"
    " volume bigint, price_change double, price_change_percent double, currency string,"
    " timestamp string, source string, exchange string, is_mock boolean, market_status string"
)

# Files read by the typed loaders.
MARKET_SNAPSHOT_CSV = _schema(
    "`Symbol` string, `Price` string, `Change %` string, `Volume` string, `Rel Volume` string,"
    " `Market cap` string, `P/E` string, `EPS dil TTM` string, `EPS dil growth TTM YoY` string,"
    " `Div yield % TTM` string, `Sector` string, `Analyst Rating` string"
)
DAILY_PRICE_CSV = _schema(
    "symbol string, trade_date string, open double, high double, low double, close double,"
    " volume bigint"
)
COMPANY_CSV = _schema("symbol string, company_name string, sector string, market_cap double")

# Members of the raw JSON rows, by bronze table.
STATEMENT_METRICS = (
    "total_revenue",
    "gross_profit",
    "net_income",
    "eps",
    "operating_expense",
    "total_assets",
    "total_liabilities",
    "free_cash_flow",
)
