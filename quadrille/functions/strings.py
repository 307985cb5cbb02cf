"""SPARQL's string, number, date and hash functions on canonical terms; built-in expressions only.

Where the function isn't defined for an argument the result is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .terms import Term, _col, compatible, dt, has_type, is_literal, is_numeric, lang, lex, literal, string_form, typed, xsd

DECIMAL = "decimal(38,18)"


def _like(x: Column, text: Column) -> Column:
    """A literal with x's tag or type."""
    return F.when(lang(x) != "", literal(text, tag=lang(x))).when(dt(x) != "", literal(text, datatype=dt(x))).otherwise(literal(text))


def _string(x: Column) -> Column:
    return is_literal(x) & dt(x).isin("", xsd("string"))


def strlen(x: Term) -> Column:
    return F.char_length(lex(x))


def substr(x: Term, start: int | Column, length: int | Column | None = None) -> Column:
    x, start = _col(x), F.lit(start) if isinstance(start, int) else start
    length = F.lit(1 << 30) if length is None else F.lit(length) if isinstance(length, int) else length
    return F.when(is_literal(x) & (start >= 1), _like(x, F.substring(lex(x), start, length)))


def ucase(x: Term) -> Column:
    return F.when(_string(_col(x)), _like(_col(x), F.upper(lex(x))))


def lcase(x: Term) -> Column:
    return F.when(_string(_col(x)), _like(_col(x), F.lower(lex(x))))


def strstarts(x: Term, y: Term) -> Column:
    return F.when(compatible(x, y), lex(x).startswith(lex(y)))


def strends(x: Term, y: Term) -> Column:
    return F.when(compatible(x, y), lex(x).endswith(lex(y)))


def contains(x: Term, y: Term) -> Column:
    return F.when(compatible(x, y), F.contains(lex(x), lex(y)))


def _none(x: Column) -> Column:
    return F.when(dt(x) == xsd("string"), typed(F.lit(""), "string")).otherwise(literal(F.lit("")))


def strbefore(x: Term, y: Term) -> Column:
    x = _col(x)
    place = F.position(lex(y), lex(x))
    return F.when(compatible(x, y), F.when(place > 0, _like(x, F.substring(lex(x), F.lit(1), place - 1))).otherwise(_none(x)))


def strafter(x: Term, y: Term) -> Column:
    x = _col(x)
    place = F.position(lex(y), lex(x))
    return F.when(compatible(x, y), F.when(place > 0, _like(x, F.substring(lex(x), place + F.char_length(lex(y)), F.lit(1 << 30)))).otherwise(_none(x)))


def encode_for_uri(x: Term) -> Column:
    text = F.url_encode(string_form(x))
    return literal(F.replace(F.replace(F.replace(text, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")))


def concat(*xs: Term) -> Column:
    cols = [_col(x) for x in xs]
    text = F.concat(*[lex(c) for c in cols])
    all_of = lambda f: F.lit(True) if len(cols) == 1 else _and([f(c) == f(cols[0]) for c in cols[1:]])
    made = F.when((lang(cols[0]) != "") & all_of(lang), literal(text, tag=lang(cols[0]))).when((dt(cols[0]) != "") & all_of(dt), literal(text, datatype=dt(cols[0]))).otherwise(literal(text))
    return F.when(_and([is_literal(c) for c in cols]), made)


def _and(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out &= c
    return out


def replace(x: Term, pattern: str, replacement: str, flags: str = "") -> Column:
    """Every match; groups in the replacement as \\1. The result is a plain literal."""
    flags = "".join(f for f in flags if f in "ismx")
    java = replacement.replace("\\", "\0").replace("$", "\\$").replace("\0", "$")
    return F.when(is_literal(_col(x)), literal(F.regexp_replace(lex(x), f"(?{flags}){pattern}" if flags else pattern, java)))


def _number(x: Term) -> Column:
    return F.when(is_numeric(x), lex(x).try_cast(DECIMAL))


def _plain_number(value: Column) -> Column:
    """Decimal text without trailing zeros."""
    text = value.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def _same_type(x: Term, value: Column) -> Column:
    return literal(_plain_number(value), datatype=dt(x))


def _numeric(x: Term, exact: Callable[[Column], Column], double: Callable[[Column], Column]) -> Column:
    """A function of a number with the number's type. Doubles and floats that a decimal can't hold, INF and NaN among them,
    take the double form."""
    value = F.when(is_numeric(x), lex(x).try_cast("double"))
    made = double(value)
    text = F.when(F.isnan(made), F.lit("NaN")).when(made == float("inf"), F.lit("INF")).when(made == float("-inf"), F.lit("-INF")).otherwise(F.regexp_replace(made.cast("string"), r"\.0(?=$|E)", ""))
    wide = has_type(x, "double", "float") & _number(x).isNull()
    return F.when(wide, literal(text, datatype=dt(x))).otherwise(_same_type(x, exact(_number(x))))


def _unrounded(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """What f does to doubles that have fractions; beyond 2^53 all are whole, and casts to long would cut them."""
    return lambda v: F.when(F.isnan(v) | (F.abs(v) >= 2.0**53), v).otherwise(f(v).cast("double"))


def abs_(x: Term) -> Column:
    return _numeric(x, F.abs, F.abs)


def round_(x: Term) -> Column:
    """Half up, towards positive infinity."""
    return _numeric(x, lambda v: F.floor(v + F.lit(0.5).cast("decimal(2,1)")), _unrounded(lambda v: F.floor(v + 0.5)))


def ceil(x: Term) -> Column:
    return _numeric(x, F.ceil, _unrounded(F.ceil))


def floor(x: Term) -> Column:
    return _numeric(x, F.floor, _unrounded(F.floor))


def rand() -> Column:
    return typed(F.rand().cast("string"), "double")


def _match(x: Term, pattern: str, group: int = 1) -> Column:
    found = F.regexp_extract(lex(x), pattern, group)
    return F.when(found != "", found)


DAY = r"^(-?[0-9]{4,})-([0-9]{2})-([0-9]{2})"
CLOCK = r"(?:^|T)([0-9]{2}):([0-9]{2}):([0-9]{2}(?:\.[0-9]+)?)"
ZONE = r"T[0-9:.]+(Z|[+-][0-9]{2}:[0-9]{2})$"


def year(x: Term) -> Column:
    return _match(x, DAY, 1).try_cast("int")


def month(x: Term) -> Column:
    return _match(x, DAY, 2).try_cast("int")


def day(x: Term) -> Column:
    return _match(x, DAY, 3).try_cast("int")


def hours(x: Term) -> Column:
    return _match(x, CLOCK, 1).try_cast("int")


def minutes(x: Term) -> Column:
    return _match(x, CLOCK, 2).try_cast("int")


def seconds(x: Term) -> Column:
    return _match(x, CLOCK, 3).try_cast("decimal(18,6)")


def tz(x: Term) -> Column:
    return F.when(dt(x) == xsd("dateTime"), literal(_match(x, ZONE)))


def timezone(x: Term) -> Column:
    zone = _match(x, ZONE)
    hour, minute = (F.regexp_extract(zone, r"^[+-]([0-9]{2}):([0-9]{2})$", k).try_cast("int") for k in (1, 2))
    parts = F.concat(F.when(zone.startswith("-"), F.lit("-PT")).otherwise(F.lit("PT")), F.when(hour > 0, F.concat(hour.cast("string"), F.lit("H"))).otherwise(F.lit("")), F.when(minute > 0, F.concat(minute.cast("string"), F.lit("M"))).otherwise(F.lit("")))
    text = F.when((zone == "Z") | ((hour == 0) & (minute == 0)), F.lit("PT0S")).when((hour <= 14) & (minute < 60), parts)
    return F.when(dt(x) == xsd("dateTime"), typed(text, "dayTimeDuration"))


def now() -> Column:
    return typed(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"), "dateTime")


def md5(x: Term) -> Column:
    return literal(F.md5(string_form(x)))
