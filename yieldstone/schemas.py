"""Declared schemas of the stored tables and the checks made before a job starts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


PRICE = _struct(
    date=DateType(),
    ticker=StringType(),
    open=DoubleType(),
    high=DoubleType(),
    low=DoubleType(),
    close=DoubleType(),
    volume=LongType(),
    adj_close=DoubleType(),
    ingest_at=TimestampType(),
)

DIVIDEND = _struct(
    ex_date=DateType(),
    ticker=StringType(),
    amount=DoubleType(),
    date=DateType(),
    ingest_at=TimestampType(),
)

METRICS = _struct(
    date=DateType(),
    ticker=StringType(),
    last_price=DoubleType(),
    market_cap=LongType(),
    dividend_ttm=DoubleType(),
    dividend_yield_ttm=DoubleType(),
    div_count_1y=LongType(),
    last_div_date=DateType(),
    updated_at=TimestampType(),
)

CHANGES = _struct(
    effective_date=DateType(),
    action=StringType(),
    ticker=StringType(),
    description=StringType(),
    year=IntegerType(),
)

MEMBERSHIP = _struct(
    date=DateType(),
    ticker=StringType(),
    in_dt=DateType(),
    out_dt=DateType(),
    is_member=BooleanType(),
)

PROFILE = _struct(
    ticker=StringType(),
    company_name=StringType(),
    sector=StringType(),
    has_dividend=BooleanType(),
    dividend_yield=DoubleType(),
    dividend_rate=DoubleType(),
    ex_dividend_date=LongType(),
    payment_date=LongType(),
    dividend_frequency=IntegerType(),
    market_cap=LongType(),
    last_price=DoubleType(),
    ingest_at=TimestampType(),
)

# Event days that stored metrics were computed from.
APPLIED = _struct(
    ticker=StringType(),
    ex_date=DateType(),
    amount=DecimalType(38, 18),
    events=LongType(),
    month=DateType(),
)

MARKS = _struct(
    ticker=StringType(),
    mark=DateType(),
    date=DateType(),
)

#: Landed prices as they came, by month and by the part of a stream that brought them.
LANDED_PRICE = StructType([*PRICE.fields, StructField("month", DateType()), StructField("batch", StringType())])

#: What price views carry on from: of each ticker its peak so far and its last rows, as of ``date``.
PRICE_STATE = _struct(
    date=DateType(),
    ticker=StringType(),
    peak=DoubleType(),
    tail=ArrayType(_struct(date=DateType(), close=DoubleType(), adj_close=DoubleType())),
)

#: Daily prices with all that the price views add.
PRICE_VIEW = StructType(
    [
        *PRICE.fields,
        *[
            StructField(name, DoubleType())
            for name in "prev_close prev_adj_close ret_1d_close ret_1d_adj ma_7 ma_30 ma_120 vol_30d rolling_peak drawdown".split()
        ],
    ]
)

# A member from ``in_dt`` on, until the day before ``out_dt``.
SPELLS = _struct(
    ticker=StringType(),
    in_dt=DateType(),
    out_dt=DateType(),
)

QUARANTINE = _struct(
    source=StringType(),
    day=DateType(),
    ticker=StringType(),
    reason=StringType(),
    record=StringType(),
    rows=LongType(),
)

PRICE_REQUIRED = ["date", "ticker", "open", "high", "low", "close", "volume"]
DIVIDEND_REQUIRED = ["ex_date", "ticker", "amount", "date"]


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Raise on the driver, before any job runs, when a column is missing."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df


def project(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order, cast to its types; extra columns are dropped."""
    require_columns(df, schema.names)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
