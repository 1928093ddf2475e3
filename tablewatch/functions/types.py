"""Type families used for dispatch (driver-side schema metadata only, no job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TIMESTAMP_TYPES = (T.TimestampType, T.TimestampNTZType)


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def is_floating(dt: T.DataType) -> bool:
    """Only float/double can hold NaN."""
    return isinstance(dt, (T.FloatType, T.DoubleType))


def is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, T.IntegralType)


def is_timestamp(dt: T.DataType) -> bool:
    return isinstance(dt, TIMESTAMP_TYPES)


def is_datetime(dt: T.DataType) -> bool:
    return isinstance(dt, TIMESTAMP_TYPES + (T.DateType,))


def is_string(dt: T.DataType) -> bool:
    return isinstance(dt, T.StringType)


def is_orderable(dt: T.DataType) -> bool:
    """Maps (anywhere inside) cannot be compared, grouped in sets or sorted."""
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return is_orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(is_orderable(f.dataType) for f in dt.fields)
    return True


_FAMILIES = {
    "numeric": is_numeric,
    "floating": is_floating,
    "integral": is_integral,
    "timestamp": is_timestamp,
    "datetime": is_datetime,
    "string": is_string,
}


def columns_of(df: DataFrame, family: str) -> list[str]:
    """Names of the columns of one type family, in schema order."""
    try:
        test = _FAMILIES[family]
    except KeyError:
        raise ValueError(f"unknown type family {family!r}; one of {sorted(_FAMILIES)}") from None
    return [f.name for f in df.schema.fields if test(f.dataType)]


def require(df: DataFrame, name: str, test, what: str) -> T.DataType:
    dt = dtype(df, name)
    if not test(dt):
        raise ValueError(f"column {name!r} is {dt.simpleString()}, not {what}")
    return dt
