"""Timestamps without zone, so that results do not move with the session zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

NTZ = "timestamp_ntz"


def ntz(value: datetime | str | Column) -> Column:
    """``value`` as a zone-less timestamp column."""
    if isinstance(value, Column):
        return value.cast(NTZ)
    if isinstance(value, datetime) and value.tzinfo is not None:
        raise ValueError(f"expected a datetime without zone, got {value!r}")
    return F.lit(str(value)).cast(NTZ)


def with_ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Cast the named columns to zone-less timestamps where they are not so already."""
    to_cast = [c for c in columns if not isinstance(df.schema[c].dataType, TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast(NTZ) for c in to_cast}) if to_cast else df


def comparable(df: DataFrame, column: str, value: datetime | str | Column) -> tuple[Column, Column]:
    """``df[column]`` and ``value`` in one type, without a cast on a timestamp column.

    A cast around the column would keep the comparison out of the file scan, so for a zoned
    column it is the value that is converted.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, TimestampNTZType):
        return F.col(column), ntz(value)
    if isinstance(dtype, TimestampType):
        return F.col(column), ntz(value).cast("timestamp")
    return F.col(column).cast(NTZ), ntz(value)


def iso_text(column: Column) -> Column:
    """ISO-8601 text with six fraction digits, or none when the fraction is zero."""
    text = column.cast(NTZ).cast("string")
    fraction = F.when(F.length(text) > 19, F.rpad(F.substring(text, 20, 7), 7, "0")).otherwise("")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), fraction)
