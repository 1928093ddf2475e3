"""Row-level predicates (native Column expressions, codegen-friendly).

Every "bad row" predicate follows SQL three-valued logic: a row counts as bad only when
the predicate is TRUE; a NULL predicate is not bad. ``count_if`` over these gives the
same numbers as ``filter(pred).count()``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import types as TY
from .names import col


def is_missing(c: Column, dt: T.DataType) -> Column:
    """NULL, or NaN for float/double columns."""
    if TY.is_floating(dt):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def differs(a: Column, b: Column, null_safe: bool = False) -> Column:
    """``a != b`` (W4/W5); with ``null_safe`` a NULL on exactly one side also differs."""
    return ~a.eqNullSafe(b) if null_safe else a != b


def outside(c: Column, lo=None, hi=None) -> Column:
    """Strictly below ``lo`` or above ``hi``; bounds themselves are valid."""
    parts = []
    if lo is not None:
        parts.append(c < F.lit(lo) if not isinstance(lo, Column) else c < lo)
    if hi is not None:
        parts.append(c > F.lit(hi) if not isinstance(hi, Column) else c > hi)
    if not parts:
        raise ValueError("give at least one bound")
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def inside(c: Column, lo, hi) -> Column:
    """Closed range ``lo <= c <= hi`` (W7); NULL is not inside."""
    return c.between(lo, hi)


def not_in(c: Column, values, allow_null: bool = True) -> Column:
    """Value not in the allowed list.

    NULL entries of the list are ignored (with SQL ``NOT IN`` a NULL in the list would
    make the predicate never TRUE). A NULL value is bad only with ``allow_null=False``, or
    where nothing is allowed: then every row is bad.
    """
    vals = [v for v in values if v is not None]
    if not vals:
        return F.lit(True)
    pred = ~c.isin(vals)
    if allow_null:
        return c.isNotNull() & pred
    return c.isNull() | pred


def typed_literal(value, dt: T.DataType) -> Column:
    """Literal of the column's own type, so timestamp_ntz columns get ntz bounds."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value) if not isinstance(value, (int, float)) else value).cast(dt)


def now_for(dt: T.DataType) -> Column:
    """'Now' in the column's type: local wall clock for timestamp_ntz."""
    if isinstance(dt, T.TimestampNTZType):
        return F.localtimestamp()
    if isinstance(dt, T.DateType):
        return F.current_date()
    return F.current_timestamp()


def timestamp_implausible(c: Column, dt: T.DataType, lo="1900-01-01 00:00:00", hi=None) -> Column:
    """NULL, before ``lo`` or after ``hi`` (default: now) (V8)."""
    lo_c = typed_literal(lo, dt)
    hi_c = now_for(dt) if hi is None else typed_literal(hi, dt)
    return c.isNull() | (c < lo_c) | (c > hi_c)


# ---------------------------------------------------------------------------
# Timestamp text formats (V9)
#
# The field patterns Python's ``datetime.strptime`` accepts for each
# directive (its parser is case-insensitive, needs the whole text to match and lets a
# whitespace run in the format match one or more whitespace characters).
STRPTIME_FIELDS = {
    "Y": r"\d\d\d\d",
    "y": r"\d\d",
    "m": r"1[0-2]|0[1-9]|[1-9]",
    "d": r"3[01]|[12]\d|0[1-9]|[1-9]| [1-9]",
    "H": r"2[0-3]|[0-1]\d|\d",
    "I": r"1[0-2]|0[1-9]|[1-9]",
    "M": r"[0-5]\d|\d",
    "S": r"6[0-1]|[0-5]\d|\d",
    "f": r"[0-9]{1,6}",
    "p": r"am|pm",
    "j": r"36[0-6]|3[0-5]\d|[1-2]\d\d|0[1-9]\d|00[1-9]|[1-9]\d|0[1-9]|[1-9]",
    "U": r"5[0-3]|[0-4]\d|\d",
    "W": r"5[0-3]|[0-4]\d|\d",
    "w": r"[0-6]",
    "G": r"\d\d\d\d",
    "V": r"5[0-3]|0[1-9]|[1-4]\d|\d",
    "u": r"[1-7]",
    "a": r"mon|tue|wed|thu|fri|sat|sun",
    "A": r"monday|tuesday|wednesday|thursday|friday|saturday|sunday",
    "b": r"jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec",
    "B": r"january|february|march|april|may|june|july|august|september|october|november|december",
    "Z": r"utc|gmt",
    "z": r"[+-](?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?|[0-5]\d(?:[0-5]\d(?:\.\d{1,6})?)?)|(?-i:Z)",
}
# What these directives stand for in the C locale.
STRPTIME_SHORTHANDS = {"c": "%a %b %d %H:%M:%S %Y", "x": "%m/%d/%y", "X": "%H:%M:%S"}
# Two-digit years: 69..99 are 19xx, 00..68 are 20xx.
TWO_DIGIT_YEAR_PIVOT = 69


def strptime_regex(fmt: str) -> tuple[str, list[str]]:
    """Translate a strptime format to an anchored regex and the directive of each group."""
    fmt = re.sub("%(.)", lambda m: STRPTIME_SHORTHANDS.get(m[1], m[0]), fmt)
    out, fields, i = ["^(?i)"], [], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%":
            if i + 1 >= len(fmt):
                raise ValueError(f"format ends with a lone %: {fmt!r}")
            d = fmt[i + 1]
            if d == "%":
                out.append("%")
            elif d in STRPTIME_FIELDS:
                if d in fields:
                    raise ValueError(f"directive %{d} repeated in {fmt!r}")
                out.append("(" + STRPTIME_FIELDS[d] + ")")
                fields.append(d)
            else:
                raise NotImplementedError(f"strptime directive %{d} is not supported")
            i += 2
        elif ch.isspace():
            while i < len(fmt) and fmt[i].isspace():
                i += 1
            out.append(r"\s+")
        else:
            out.append(re.escape(ch))
            i += 1
    if {"G", "V"} & set(fields) and not ({"G", "V"} <= set(fields) and set("aAwu") & set(fields)):
        raise ValueError(f"ISO year %G and week %V need each other and a weekday: {fmt!r}")
    if "G" in fields and set("jUW") & set(fields):
        raise ValueError(f"%j, %U and %W don't go with ISO year %G: {fmt!r}")
    out.append(r"\z")
    return "".join(out), fields


def strptime_parse(c: Column, fmt: str) -> Column:
    """Parse text like ``datetime.strptime(text, fmt)``; NULL where it would raise.

    Matching is a regex of the format; calendar validity (month length, leap years)
    comes from ``try_make_timestamp_ntz``. All native expressions. Names are those of the
    C locale. The result is the local time of the text: an offset or zone must be valid but
    does not move it, and week numbers and weekday names do not choose the day, except those of ISO
    years: ``%G %V`` and a weekday are a day, whatever year, month and day say.
    """
    regex, fields = strptime_regex(fmt)
    if not fields:
        return F.when(c.rlike(regex), F.lit("1900-01-01 00:00:00").cast("timestamp_ntz"))
    # Two regex evaluations per row: ``rlike`` decides validity, and of matching texts one
    # ``regexp_replace`` makes the fields, joined by a control character. The lambda's
    # variable binds them, so that each field doesn't evaluate them again.
    sep = "\u0001"
    parts = F.split(F.regexp_replace(c, regex, sep.join(f"${k + 1}" for k in range(len(fields)))), sep)
    parsed = F.transform(F.array(parts), lambda p: _strptime_value(p, fields))
    return F.when(c.rlike(regex), F.element_at(parsed, 1))


def _strptime_value(parts: Column, fields: list[str]) -> Column:
    """Timestamp of the matched fields, NULL if there is no such day or time."""
    def grab(d):
        return F.trim(F.get(parts, F.lit(fields.index(d))))

    def num(d, default):
        return grab(d).try_cast("int") if d in fields else F.lit(default)

    def named(d):
        return F.array_position(F.array(*[F.lit(n) for n in STRPTIME_FIELDS[d].split("|")]), F.lower(grab(d))).cast("int")

    if "Y" in fields:
        year = num("Y", 1900)
    elif "y" in fields:
        yy = num("y", 0)
        year = F.when(yy >= TWO_DIGIT_YEAR_PIVOT, yy + 1900).otherwise(yy + 2000)
    else:
        year = F.lit(1900)
    months = [d for d in fields if d in "mbB"]  # the last one holds
    month = F.lit(1) if not months else num("m", 1) if months[-1] == "m" else named(months[-1])
    if "I" in fields:
        hour12 = num("I", 12) % 12
        pm = F.lower(grab("p")) == "pm" if "p" in fields else F.lit(False)
        hour = hour12 + F.when(pm, 12).otherwise(0)
    else:
        hour = num("H", 0)
    second = num("S", 0)
    micros = F.rpad(grab("f"), 6, "0").try_cast("int") if "f" in fields else F.lit(0)
    seconds = (second.cast("decimal(16,6)") + micros.cast("decimal(16,6)") / F.lit(1000000)).cast("decimal(16,6)")
    ok = (second < 60) & (year >= 1)
    if "G" in fields:
        iso = _iso_day(num("G", 1), num("V", 1), _weekday(fields, num, named))
        return F.when(ok & (num("G", 1) >= 1) & (F.year(iso) <= 9999), F.try_make_timestamp_ntz(
            F.year(iso), F.month(iso), F.dayofmonth(iso), hour, num("M", 0), seconds))
    if "j" in fields:  # the day of the year holds, whatever month and day say
        midnight = F.try_make_timestamp_ntz(year, F.lit(1), F.lit(1), hour, num("M", 0), seconds)
        ts = midnight + F.make_dt_interval(num("j", 1) - 1)
        return F.when(ok & ((year < 9999) | (num("j", 1) < 366)), ts)
    return F.when(ok, F.try_make_timestamp_ntz(year, month, num("d", 1), hour, num("M", 0), seconds))


def _weekday(fields: list[str], num, named) -> Column:
    """ISO weekday (Monday is 1) of the last weekday field."""
    d = [d for d in fields if d in "aAwu"][-1]
    if d == "w":
        return F.when(num(d, 0) == 0, 7).otherwise(num(d, 0))
    return num(d, 1) if d == "u" else named(d)


def _iso_day(year: Column, week: Column, weekday: Column) -> Column:
    """Date of an ISO year, week and weekday, NULL where the year has no such week."""
    monday = F.next_day(F.date_sub(F.make_date(year, F.lit(1), F.lit(4)), 7), "MON")
    weeks = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))  # December 28 is always in the last week
    return F.when((week >= 1) & (week <= weeks), F.date_add(monday, (week - 1) * 7 + weekday - 1))


def timestamp_text_invalid(c: Column, dt: T.DataType, fmt: str = "%Y-%m-%d %H:%M:%S") -> Column:
    """Text that ``strptime(text, fmt)`` would reject, NULL included (V9).

    A native timestamp/date column has no text form to check: only NULL is invalid.
    """
    if TY.is_datetime(dt):
        return c.isNull()
    if not TY.is_string(dt):
        raise ValueError(f"timestamp format check needs a string or timestamp column, got {dt.simpleString()}")
    return strptime_parse(c, fmt).isNull()


# Text that Spark could parse as an integer holds only ASCII digits, a sign, a decimal
# point and whitespace (bytes up to 0x20, which the parser trims). Any other character
# makes ``try_cast`` return NULL, which this guard answers without the exception path.
_NOT_INTEGRAL_TEXT = r"[^0-9+\-.\x00-\x20]"


def text_try_cast(c: Column, source: T.DataType, target) -> Column:
    """``try_cast`` with a fast path for text that cannot be an integer.

    Same result as ``c.try_cast(target)``. For text to an integral type, values
    containing any character the integer parser never accepts become NULL through a
    cheap ``rlike`` test instead of Spark's failing parse.
    """
    dt = T._parse_datatype_string(target) if isinstance(target, str) else target
    if TY.is_string(source) and isinstance(dt, T.IntegralType):
        return F.when(c.rlike(_NOT_INTEGRAL_TEXT), F.lit(None).cast(dt)).otherwise(c.try_cast(dt))
    return c.try_cast(dt)


def comparable_pair(df: DataFrame, a: str, b: str) -> tuple[Column, Column]:
    """Column pair for a consistency comparison (V3).

    If exactly one side is a string, it is converted with ``try_cast``, so text that is no
    number/date becomes NULL (not counted) instead of failing the job under ANSI casting.
    Text against whole numbers is compared in a type that holds both: ``'2.7'`` differs
    from 1, and so does text beyond the range of integers. Other types: the other side's.
    """
    da, db = df.schema[a].dataType, df.schema[b].dataType
    ca, cb = col(a), col(b)
    if TY.is_string(da) and not TY.is_string(db):
        return _text_beside(ca, cb, db)
    if TY.is_string(db) and not TY.is_string(da):
        return tuple(reversed(_text_beside(cb, ca, da)))
    return ca, cb


# Holds every bigint and 18 places behind the point; the largest such number equals none.
_EXACT = T.DecimalType(38, 18)
_NOT_NUMBER_TEXT = r"[^0-9+\-.eE\x00-\x20]"


def _text_beside(text: Column, other: Column, dt: T.DataType) -> tuple[Column, Column]:
    if not isinstance(dt, T.IntegralType):
        return text_try_cast(text, T.StringType(), dt), other
    exact, number = text.try_cast(_EXACT), text.try_cast("double")
    beyond = F.when(number.isNotNull(), F.lit("9" * 20).cast(_EXACT))
    value = F.when(~text.rlike(_NOT_NUMBER_TEXT), F.coalesce(exact, beyond))
    return value, other.cast(_EXACT)
