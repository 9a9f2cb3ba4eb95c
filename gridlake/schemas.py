"""Explicit schemas of every landed file, table and message.

Reads never infer: a measure column that is empty for a day would come back with another type.
"""

from pyspark.sql import types as T

from gridlake.constants import ZONE_COLUMNS

NUMERIC = "decimal(18,6)"


def _schema(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_DATE, _TS, _STR = T.DateType(), T.TimestampType(), T.StringType()
_F64, _I64, _I32 = T.DoubleType(), T.LongType(), T.IntegerType()

ZONE_PRICES = _schema(
    ("date", _DATE, False), ("timestamp", _TS, False), ("zone", _STR, False),
    ("price_eur_mwh", _F64, True),
)
ZONE_GENERATION = _schema(
    ("date", _DATE, False), ("timestamp", _TS, False), ("zone", _STR, False),
    ("fuel_type", _STR, False), ("generation_mw", _F64, True),
)

# Landed files carry no date; `country` and `dt` are the directory levels.
LANDED_PRICES = _schema(
    ("timestamp", _TS, True), ("price_eur_mwh", _F64, True), ("zone", _STR, True),
    ("country", _STR, True), ("dt", _STR, True),
)
LANDED_GENERATION = _schema(
    ("timestamp", _TS, True), ("fuel_type", _STR, True), ("generation_mw", _F64, True),
    ("zone", _STR, True), ("country", _STR, True), ("dt", _STR, True),
)

COUNTRY_PRICES = _schema(
    ("timestamp", _TS, True), ("price_eur_mwh", _F64, True), ("country", _STR, True),
    ("ingested_at", _TS, True),
)
COUNTRY_GENERATION = _schema(
    ("timestamp", _TS, True), ("fuel_type", _STR, True), ("generation_mw", _F64, True),
    ("country", _STR, True),
)

DEMAND_BATCH = _schema(
    ("doba", _STR, True), ("udtczas", _STR, True), ("zap_kse", _F64, True),
    ("znacznik", _I64, True), ("ingested_at", _TS, True),
)
DEMAND_RECORD = _schema(("business_date", _STR, True), ("dtime", _STR, True), ("demand", _F64, True))
DEMAND_ENVELOPE = T.StructType([T.StructField("value", T.ArrayType(DEMAND_RECORD), True)])

# `demand_mw` is nullable in storage; the quality contract demands a value.
DEMAND_STREAM = _schema(
    ("event_ts", _TS, False), ("demand_date", _DATE, False), ("interval_id", _I64, False),
    ("demand_mw", _F64, True), ("source", _STR, True), ("ingested_at", _TS, True),
)
DEMAND_MESSAGE = _schema(
    ("event_ts", _I64, False), ("demand_date", _DATE, False), ("interval_id", _I32, False),
    ("demand_mw", _F64, False), ("source", _STR, True), ("ingested_at", _I64, False),
)
KEYED_MESSAGE = _schema(("key", _STR, True), ("value", _STR, True))

QUOTES = _schema(
    ("date", _DATE, True), ("ticker", _STR, True), ("open", _F64, True), ("high", _F64, True),
    ("low", _F64, True), ("close", _F64, True), ("volume", _F64, True),
)

ZONE_DIM = _schema(*[(name, _STR, True) for name in ZONE_COLUMNS])
ZONE_CONFIG = T.StructType([
    T.StructField("description", _STR, True),
    T.StructField("zones", T.ArrayType(_schema(
        ("code", _STR, True), ("country", _STR, True), ("region", _STR, True),
        ("timezone", _STR, True), ("primary_fuel", _STR, True), ("zone_name", _STR, True),
    )), True),
])

BACKFILL_PROGRESS = _schema(("zone", _STR, False), ("year", _I32, False))
