"""Equality, order, keys for joins and grouping, and casts between terms and native types.

term_eq and term_lt follow SPARQL's value comparison; where SPARQL has an error the result is null, or with
on_error="raise" the query fails. A null operand gives null in both modes.
`join_key` is equal for equal terms (equal keys may still differ: keep term_eq as a residual), `group_key` is an exact
equivalence for grouping.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .terms import Term, _col, dt, has_numeric_type, has_type, is_blank, is_iri, is_literal, is_plain, lang, let, lex, suffix, typed

EXACT = "decimal(38,18)"
DAY_MICROS = 86_400_000_000


def number(x: Term) -> Column:
    return F.when(has_numeric_type(x), lex(x).try_cast("double"))


def exact(x: Term) -> Column:
    return F.when(has_numeric_type(x), lex(x).try_cast(EXACT))


def _floating(x: Term) -> Column:
    return has_type(x, "float", "double")


def category(x: Term) -> Column:
    """0 strings, IRIs and blank nodes, 1 numbers, 2 dateTime, 3 date, 4 time, 5 duration, 6 others."""
    out = F.when(~is_literal(x) | is_plain(x) | suffix(x).startswith("@"), 0).when(has_numeric_type(x), 1)
    for k, name in enumerate(("dateTime", "date", "time", "duration"), 2):
        out = out.when(has_type(x, name), k)
    return out.otherwise(6)


def _temporal(x: Term) -> Column:
    return has_type(x, "date", "dateTime", "time")


def _zone(text: Column) -> Column:
    """A text's offset as it is written: Z, +hh:mm, -hh:mm or nothing."""
    numeric = F.substring(text, -6, 1).isin("+", "-") & (F.substring(text, -3, 1) == ":")
    return F.when(text.endswith("Z"), F.lit("Z")).when(numeric, F.substring(text, -6, 6)).otherwise(F.lit(""))


def _zoned(text: Column) -> Column:
    return _zone(text) != ""


def moment(x: Term) -> Column:
    """Microseconds of a date, dateTime or time on one line; with an offset applied where there is one."""
    return F.when(_temporal(x), let(lex(x), lambda text: let(_zone(text), lambda zone: _moment(x, text, zone))))


def _moment(x: Term, text: Column, zone: Column) -> Column:
    bare = F.substring(text, F.lit(1), F.char_length(text) - F.char_length(zone))
    minutes = F.substring(zone, 2, 2).cast("long") * 60 + F.substring(zone, 5, 2).cast("long")
    shift = F.when(zone.startswith("-"), minutes).when(zone.startswith("+"), -minutes).otherwise(F.lit(0))
    clock = F.when(has_type(x, "time"), F.concat(F.lit("1970-01-01T"), bare)).otherwise(bare)
    stamp = F.unix_micros(F.concat(clock, F.lit("Z")).try_cast("timestamp"))
    days = F.unix_date(F.substring(bare, 1, 10).try_cast("date")).cast("long") * DAY_MICROS
    micros = F.when(has_type(x, "time") | (has_type(x, "dateTime") & F.contains(bare, F.lit("T"))), stamp).otherwise(days)
    return micros + shift * 60_000_000


def duration_parts(x: Term) -> tuple[Column, Column, Column]:
    """Months, days and microseconds of an xsd:duration."""
    return _duration_of(lex(x))


def _duration_of(text: Column) -> tuple[Column, Column, Column]:
    ok = text.rlike(r"^-?P(?=[0-9T])(?:-?[0-9]+Y)?(?:-?[0-9]+M)?(?:-?[0-9]+W)?(?:-?[0-9]+D)?(?:T(?=[0-9-])(?:-?[0-9]+H)?(?:-?[0-9]+M)?(?:-?[0-9.]+S)?)?$")
    get = lambda p: F.coalesce(F.regexp_extract(text, p, 1).try_cast("decimal(20,6)"), F.lit(0))
    sign = F.when(text.startswith("-"), -1).otherwise(1)
    months = get(r"^[^T]*?(-?[0-9]+)Y") * 12 + get(r"^[^T]*?(-?[0-9]+)M")
    days = get(r"^[^T]*?(-?[0-9]+)W") * 7 + get(r"^[^T]*?(-?[0-9]+)D")
    micros = (get(r"T.*?(-?[0-9]+)H") * 3600 + get(r"T.*?(-?[0-9]+)M") * 60 + get(r"T.*?(-?[0-9.]+)S")) * 1_000_000
    return tuple(F.when(ok, (sign * v).cast("long")) for v in (months, days, micros))


def duration(x: Term) -> Column:
    """Microseconds, a month as 30 days and a day as 24 hours."""
    def total(text: Column) -> Column:
        months, days, micros = _duration_of(text)
        return (months * 30 + days) * DAY_MICROS + micros

    return let(lex(x), total)


def truth(x: Term) -> Column:
    return F.when(lex(x).isin("true", "1"), True).when(lex(x).isin("false", "0"), False)


def term_eq(a: Term, b: Term, on_error: str = "null") -> Column:
    return let(_col(a), lambda x: let(_col(b), lambda y: _strict(_equal(x, y), "compare", on_error, x, y)))


def _equal(a: Column, b: Column) -> Column:
    both = lambda f: f(a) & f(b)
    # doubles that differ come from numbers that differ, in the same order: the exact comparison is for ties only
    numbers = _with_doubles(a, b, lambda p, q: F.when(p != q, F.lit(False)).when(_floating(a) | _floating(b), (p == q) & ~F.isnan(p)).otherwise(lex(a).try_cast(EXACT) == lex(b).try_cast(EXACT)))
    temporal = F.when(_zoned(lex(a)) != _zoned(lex(b)), F.lit(False)).otherwise(moment(a) == moment(b))
    same_kind = (
        F.when(_temporal(a), temporal)
        .when(has_type(a, "boolean"), truth(a) == truth(b))
        .when(has_type(a, "duration"), duration(a) == duration(b))
        .otherwise(lex(a) == lex(b))
    )
    return (
        F.when(a == b, F.lit(True))
        .when(a.isNull() | b.isNull(), F.lit(None).cast("boolean"))
        .when(~both(is_literal), F.lit(False))
        .when(both(has_numeric_type), numbers)
        .when(both(is_plain), lex(a) == lex(b))
        .when(suffix(a).startswith("@") | suffix(b).startswith("@"), (F.lower(suffix(a)) == F.lower(suffix(b))) & (lex(a) == lex(b)))
        .when(suffix(a) != suffix(b), F.lit(False))
        .otherwise(same_kind)
    )


def _strict(result: Column, what: str, on_error: str, *operands: Column) -> Column:
    """The result, or with on_error="raise" an error where it is null although no operand is."""
    if on_error not in ("null", "raise"):
        raise ValueError('on_error is "null" or "raise"')
    if on_error == "null":
        return result
    present = reduce(lambda p, q: p & q, [c.isNotNull() for c in operands])
    shown = F.concat_ws(" and ", *[c.cast("string") for c in operands])
    error = F.raise_error(F.concat(F.lit(f"cannot {what} "), shown)).cast("boolean")
    return let(result, lambda r: F.when(r.isNull() & present, error).otherwise(r))


def _order(a: Term, b: Term, compare, on_error: str) -> Column:
    """A comparison where both are of one ordered kind, else null or an error."""
    return let(_col(a), lambda x: let(_col(b), lambda y: _strict(_ordered(x, y, compare), "order", on_error, x, y)))


def _with_doubles(a: Column, b: Column, body) -> Column:
    return let(lex(a).try_cast("double"), lambda p: let(lex(b).try_cast("double"), lambda q: body(p, q)))


def _ordered(a: Column, b: Column, compare) -> Column:
    same = suffix(a) == suffix(b)
    numbers = _with_doubles(
        a, b, lambda p, q: F.when(F.isnan(p) | F.isnan(q), F.lit(False)).when((p != q) | has_type(a, "double"), compare(p, q)).otherwise(F.coalesce(compare(lex(a).try_cast(EXACT), lex(b).try_cast(EXACT)), compare(p, q)))
    )
    return (
        F.when(has_numeric_type(a) & has_numeric_type(b), numbers)
        .when(is_plain(a) & is_plain(b), compare(lex(a), lex(b)))
        .when(same & _temporal(a), F.when(_zoned(lex(a)) != _zoned(lex(b)), F.lit(False)).otherwise(compare(moment(a), moment(b))))
        .when(same & has_type(a, "duration"), compare(duration(a), duration(b)))
        .when(same & has_type(a, "boolean"), compare(truth(a), truth(b)))
    )


def term_ne(a: Term, b: Term, on_error: str = "null") -> Column:
    return ~term_eq(a, b, on_error)


def term_lt(a: Term, b: Term, on_error: str = "null") -> Column:
    return _order(a, b, lambda x, y: x < y, on_error)


def term_le(a: Term, b: Term, on_error: str = "null") -> Column:
    return _order(a, b, lambda x, y: x <= y, on_error)


def term_gt(a: Term, b: Term, on_error: str = "null") -> Column:
    return _order(a, b, lambda x, y: x > y, on_error)


def term_ge(a: Term, b: Term, on_error: str = "null") -> Column:
    return _order(a, b, lambda x, y: x >= y, on_error)


def term_in(x: Term, *values: Term) -> Column:
    out = F.lit(False)
    for v in values:
        out |= term_eq(x, v)
    return out


def _key(x: Term, numeric: Column) -> Column:
    """Marked text of a term's value. A value that can't be read leaves the null of its branch, and the text as key."""
    x = _col(x)
    tagged = lambda mark, *parts: F.concat(F.lit(mark), *[v for p in parts for v in (F.lit("|"), p)])
    value = (
        F.when(~is_literal(x), x)
        .when(has_numeric_type(x), tagged("N", numeric))
        .when(is_plain(x), tagged("S", lex(x)))
        .when(suffix(x).startswith("@"), tagged("L", F.lower(lang(x)), lex(x)))
        .when(_temporal(x), tagged("T", dt(x), _zoned(lex(x)).cast("string"), moment(x).cast("string")))
        .when(has_type(x, "boolean"), tagged("B", truth(x).cast("string")))
        .when(has_type(x, "duration"), tagged("P", duration(x).cast("string")))
    )
    return F.coalesce(value, tagged("O", dt(x), lex(x)))


def join_key(x: Term) -> Column:
    number = lambda value: F.when(~F.isnan(value), (value + F.lit(0.0)).cast("string"))
    return let(_col(x), lambda t: _key(t, let(lex(t).try_cast("double"), number)))


def group_key(x: Term) -> Column:
    return let(_col(x), _group_key)


def _group_key(x: Column) -> Column:
    text = lex(x)
    plain = F.regexp_replace(text.try_cast(EXACT).cast("string"), r"\.?0+$", "")
    value = text.try_cast("double")
    # an integer of few digits and no leading zero or sign is its own key
    short = text.rlike("^(?:0|[1-9][0-9]{0,17})$")
    return _key(x, F.when(short, text).otherwise(F.coalesce(F.when(plain == "-0", F.lit("0")).otherwise(plain), F.when(~F.isnan(value), value.cast("string")))))


def sort_struct(x: Term) -> Column:
    """For min and max: by category, then by value, then by text."""
    return let(_col(x), _sort_struct)


def _sort_struct(x: Column) -> Column:
    def parts(category: Column, rank: Column, value: Column, tag: Column) -> Column:
        return F.struct(category.alias("category"), rank.alias("rank"), value.alias("value"), tag.alias("lang"), lex(x).alias("lex"))

    none = F.lit(None).cast(EXACT)
    float_value = F.least(F.greatest(lex(x).try_cast("double"), F.lit(-1e19)), F.lit(1e19)).cast(EXACT)
    value = F.when(_temporal(x), moment(x).cast(EXACT)).when(has_type(x, "duration"), duration(x).cast(EXACT))
    return (
        F.when(~is_literal(x), parts(F.lit(0), F.when(is_iri(x) | is_blank(x), 0).otherwise(1), none, F.lit("")))
        .when(has_numeric_type(x), parts(F.lit(1), F.lit(1), F.coalesce(lex(x).try_cast(EXACT), float_value), F.lit("")))
        .when(is_plain(x), parts(F.lit(0), F.lit(1), none, F.lit("")))
        .when(suffix(x).startswith("@"), parts(F.lit(0), F.lit(2), none, F.lower(lang(x))))
        .otherwise(parts(category(x), F.lit(1), value, F.lit("")))
    )


# native values: the datatype counts only where the cast needs it
def to_native(x: Term, kind: str) -> Column:
    """kind: decimal, double, float, bigint, int, smallint, boolean, date, timestamp, timestamp_ntz, time (microseconds of
    the day), timetz (microseconds and offset), interval (months, days, microseconds). Null where the cast fails."""
    if kind in ("date", "timestamp", "timestamp_ntz", "time", "timetz", "interval"):
        return let(_col(x), lambda v: _to_native(v, kind))
    return _to_native(x, kind)


def _to_native(x: Term, kind: str) -> Column:
    text, bare = lex(x), F.regexp_replace(lex(x), r"(?:Z|[+-][0-9]{2}:[0-9]{2})$", "")
    dated = has_type(x, "date", "dateTime")
    if kind in ("decimal", "double"):
        return F.when(has_numeric_type(x), text.try_cast(EXACT if kind == "decimal" else "double"))
    if kind in ("float", "bigint", "int", "smallint"):
        return text.try_cast(kind)
    if kind == "boolean":
        return F.when(has_type(x, "boolean", "integer"), truth(x))
    if kind == "date":
        return F.when(dated, F.substring(bare, 1, 10).try_cast("date"))
    if kind == "timestamp":
        return F.when(dated, F.timestamp_micros(moment(x)))
    if kind == "timestamp_ntz":
        return F.when(dated, bare.try_cast("timestamp_ntz"))
    if kind == "time":
        return F.unix_micros(F.concat(F.lit("1970-01-01T"), bare, F.lit("Z")).try_cast("timestamp"))
    if kind == "timetz":
        return F.struct(_to_native(x, "time").alias("micros"), F.regexp_extract(text, r"(Z|[+-][0-9]{2}:[0-9]{2})$", 1).alias("offset"))
    if kind == "interval":
        parts = lambda t: F.struct(*[p.alias(n) for p, n in zip(_duration_of(t), ("months", "days", "micros"))])
        return F.when(has_type(x, "duration"), let(text, parts))
    raise ValueError(f"no native type {kind}")


def from_native(x: Column, kind: str) -> Column:
    """A native column to a typed literal. kind as in to_native; doubles print as Spark does, with INF and NaN."""
    names = {"smallint": "short", "int": "int", "bigint": "long", "decimal": "decimal", "boolean": "boolean", "string": "string"}
    if kind in names:
        return typed(x.cast("string"), names[kind])
    if kind in ("double", "float"):
        text = F.when(F.isnan(x), F.lit("NaN")).when(x == float("inf"), F.lit("INF")).when(x == float("-inf"), F.lit("-INF")).otherwise(F.regexp_replace(x.cast("string"), r"\.0$", ""))
        return typed(text, kind)
    if kind == "date":
        return typed(F.date_format(x, "yyyy-MM-dd"), "date")
    if kind in ("timestamp", "timestamp_ntz"):
        text = F.concat(F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss"), F.regexp_replace(F.date_format(x, ".SSSSSS"), r"\.?0*$", ""))
        return typed(F.concat(text, F.lit("Z" if kind == "timestamp" else "")), "dateTime")
    if kind in ("time", "timetz"):
        at = F.timestamp_micros(x if kind == "time" else x["micros"])
        text = F.concat(F.date_format(at, "HH:mm:ss"), F.regexp_replace(F.date_format(at, ".SSSSSS"), r"\.?0*$", ""))
        return typed(text if kind == "time" else F.concat(text, x["offset"]), "time")
    if kind == "interval":
        part = lambda v, mark: F.when(v != 0, F.concat(v.cast("string"), F.lit(mark))).otherwise(F.lit(""))
        months, days, micros = x["months"], x["days"], x["micros"]
        whole = lambda v, n: F.signum(v).cast("long") * F.floor(F.abs(v) / n)
        date = F.concat(part(whole(months, 12), "Y"), part(months - whole(months, 12) * 12, "M"), part(days, "D"))
        seconds = micros - whole(micros, 60_000_000) * 60_000_000
        fraction = F.regexp_replace((seconds.cast("decimal(20,6)") / 1_000_000).cast("decimal(20,6)").cast("string"), r"\.?0+$", "")
        clock = F.concat(part(whole(micros, 3_600_000_000), "H"), part(whole(micros, 60_000_000) - whole(micros, 3_600_000_000) * 60, "M"), F.when(seconds != 0, F.concat(fraction, F.lit("S"))).otherwise(F.lit("")))
        text = F.concat(F.lit("P"), date, F.when(clock != "", F.concat(F.lit("T"), clock)).otherwise(F.lit("")))
        return typed(F.when(text == "P", F.lit("PT0S")).otherwise(text), "duration")
    raise ValueError(f"no native type {kind}")


def _instant(value: Column) -> Column:
    """A time with an offset in an order of its own: the moment, then the offset, the western ones last."""
    hours, minutes = (F.regexp_extract(value["offset"], r"([0-9]{2}):([0-9]{2})$", k).try_cast("long") for k in (1, 2))
    east = F.coalesce(hours * 60 + minutes, F.lit(0)) * F.when(value["offset"].startswith("-"), -60_000_000).otherwise(60_000_000)
    return F.when(value["micros"].isNotNull(), F.struct((value["micros"] - east).alias("at"), (-east).alias("west")))


def compare_native(value: Column, op: str, x: Term, kind: str, on_error: str = "null") -> Column:
    """native op term: native_compare with the sides changed."""
    turned = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}
    return native_compare(x, turned.get(op, op), value, kind, on_error)


def native_compare(x: Term, op: str, value: Column, kind: str, on_error: str = "null") -> Column:
    """term op native, the datatype ignored for numbers and dates; dates that don't parse differ from everything."""
    term, operand = _col(x), value
    left = lex(x).try_cast(EXACT) if kind in ("decimal", "bigint", "int", "smallint") else lex(x).try_cast("double") if kind in ("double", "float") else F.substring(lex(x), 1, 10).try_cast("date") if kind == "date" else to_native(x, kind)
    if kind == "timetz":  # by the moment, then by the offset, as times with a zone are ordered
        left, value = _instant(left), _instant(value)
    if kind == "interval":
        left, value = duration(x), (value["months"] * 30 + value["days"]) * DAY_MICROS + value["micros"]
    made = {"=": left == value, "<>": left != value, "<": left < value, "<=": left <= value, ">": left > value, ">=": left >= value}[op]
    return F.coalesce(made, F.lit(op == "<>")) if kind == "date" else _strict(made, "compare", on_error, term, operand)


