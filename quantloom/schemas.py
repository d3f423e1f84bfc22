"""Declared schemas of the tables (D1-D19). Nothing but raw JSON is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from quantloom.plans.fundamentals import MONEY


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "decimal(38,6)": T.DecimalType(38, 6), "map<string,string>": T.MapType(T.StringType(), T.StringType()), "map<string,array<string>>": T.MapType(T.StringType(), T.ArrayType(T.StringType()))}


def _struct(text: str) -> T.StructType:
    """'name type, name type'; needs no session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (x.split(" ") for x in text.split(", "))])


CORPORATIONS = _struct("corp_code string, corp_name string, stock_code string, market string, industry_code string, fiscal_month int, status string")
FILINGS = _struct("rcept string, corp_code string, filing_type string, fy int, period string, title string, filed_at timestamp_ntz, period_end date, is_final boolean")
LINES = _struct("id long, rcept string, corp_code string, fy int, period string, statement string, basis string, table_seq int, row_order int, col_index int, label string, path string, indent int, value long, exact decimal(38,6), unit long, is_cumulative boolean, track string")
CORRECTIONS = _struct("line_id long, kind string, value long, fill string")
SHARES = _struct("rcept string, corp_code string, shares long")
PRICES = _struct("code string, day date, open long, high long, low long, close long, raw long, volume long, listed long, market_cap long")
STANDARD = T.StructType([*_struct("corp_code string, fy int, period string, basis string, period_end date, quality int").fields, *(T.StructField(c, T.LongType()) for c in MONEY), *_struct("source_rcepts map<string,string>, amend_chain map<string,array<string>>").fields])
EXTENDED = _struct("corp_code string, fy int, period string, basis string, code string, value long")
CALENDAR = T.StructType([*_struct("corp_code string, cy int, cq string, basis string, quality int, derivation string").fields, *(T.StructField(c, T.LongType()) for c in MONEY)])
EVENTS = _struct("rcept string, corp_code string, kind string, filed_at timestamp_ntz, delta long, payload string")
BUSINESS = _struct("corp_code string, fy int, metric string, segment string, item string, period_label string, value double, unit string, seq int")
BACKLOG = _struct("corp_code string, fy int, category string, backlog long, new_orders long, completed long, unit string")
AUDITS = _struct("corp_code string, fy int, period string, basis string, field string, status string, blocking boolean")
HASHES = _struct("rcept string, scope string, content_hash string, seq long, checked_at timestamp_ntz")
