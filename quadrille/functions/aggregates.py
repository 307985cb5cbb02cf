"""SPARQL aggregates as compositions of built-in ones, so they combine before the shuffle and work grouped and over windows.

`over` is a window, or None for grouping.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .compare import EXACT, sort_struct
from .terms import INTEGERS, Term, _col, has_numeric_type, has_type, let, lex, literal, string_form, xsd


def _over(c: Column, over: WindowSpec | None) -> Column:
    return c if over is None else c.over(over)


def _parts(x: Term, over: WindowSpec | None, body: Callable[[Column], Column]) -> Column:
    """body(p) of the aggregates that sum and avg need. Integers and fractions are added apart, so neither takes the other's digits."""
    x = _col(x)
    text = lex(x)
    value = F.when(has_numeric_type(x), text.try_cast("double"))
    numeric = value.isNotNull()
    rank = F.when(has_type(x, *INTEGERS), 0).when(has_type(x, "decimal"), 1).when(has_type(x, "float"), 2).otherwise(3)
    whole = text.rlike(r"^[+-]?[0-9]+$")
    plain = F.when(text.rlike("[eE]"), F.regexp_replace(text.try_cast(EXACT).cast("string"), r"\.?0+$", "")).otherwise(text)
    scale = F.least(F.char_length(F.regexp_extract(plain, r"\.([0-9]*)", 1)), F.lit(18))
    integer = F.when(whole, text.try_cast("decimal(38,0)"))
    fraction = F.when(~whole, text.try_cast(EXACT))
    run = lambda c: _over(c, over)
    parts = {
        "n": run(F.count(x)),
        "odd": run(F.max(x.isNotNull() & ~numeric)),
        "rank": run(F.max(F.when(numeric, rank))),
        "scale": F.coalesce(run(F.max(F.when(numeric, scale))), F.lit(0)),
        "whole": F.coalesce(run(F.sum(F.when(numeric, integer))), F.lit(0).cast("decimal(38,0)")),
        "fraction": F.coalesce(run(F.sum(F.when(numeric, fraction))), F.lit(0).cast(EXACT)),
        "other": run(F.sum(F.when(numeric & integer.isNull() & fraction.isNull(), value))),
    }
    return let(F.struct(*[c.alias(k) for k, c in parts.items()]), body)


def _type(rank: Column) -> Column:
    return F.when(rank == 0, F.lit(xsd("integer"))).when(rank == 1, F.lit(xsd("decimal"))).when(rank == 2, F.lit(xsd("float"))).otherwise(F.lit(xsd("double")))


def _special(value: Column) -> Column:
    return F.when(F.isnan(value), F.lit("NaN")).when(value == float("inf"), F.lit("Infinity")).when(value == float("-inf"), F.lit("-Infinity")).otherwise(value.cast("string"))


INTEGER, PLACES = "decimal(38,0)", 28


def _total(p: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    """body(sign, whole, fraction): the total's sign, its integer part and its fraction as 18 digits, both not negative."""
    def split(f: Column) -> Column:
        cut = F.when(f < 0, F.ceil(f)).otherwise(F.floor(f)).cast(INTEGER)
        return let(F.struct((p["whole"] + cut).cast(INTEGER).alias("t"), ((f - cut) * F.lit(str(10**18)).cast("decimal(19,0)")).cast("decimal(19,0)").alias("f")), level)

    def level(v: Column) -> Column:
        t, f = v["t"], v["f"]
        one, unit = F.lit(1).cast(INTEGER), F.lit(str(10**18)).cast("decimal(19,0)")
        t, f = (
            F.when((t > 0) & (f < 0), t - one).when((t < 0) & (f > 0), t + one).otherwise(t).cast(INTEGER),
            F.when((t > 0) & (f < 0), f + unit).when((t < 0) & (f > 0), f - unit).otherwise(f).cast("decimal(19,0)"),
        )
        sign = F.when((t < 0) | (f < 0), F.lit("-")).otherwise(F.lit(""))
        return let(F.struct(sign.alias("s"), F.abs(t).alias("t"), F.abs(f).alias("f")), lambda u: body(u["s"], u["t"], u["f"]))

    return let(p["fraction"], split)


def rdf_sum(x: Term, over: WindowSpec | None = None) -> Column:
    """Exact for integers of 38 digits and 18 places; null if any input isn't a number or there is none; the widest type;
    the largest scale of the inputs. INF and NaN, and numbers too large for that, make it a sum of doubles."""
    return _parts(x, over, _sum)


def _sum(p: Column) -> Column:
    digits = lambda f: F.substring(F.lpad(f.cast("string"), 18, "0"), F.lit(1), p["scale"])
    exact = _total(p, lambda s, t, f: F.concat(s, t.cast("string"), F.when(p["scale"] > 0, F.concat(F.lit("."), digits(f))).otherwise(F.lit(""))))
    wide = _special(p["other"] + p["whole"].cast("double") + p["fraction"].cast("double"))
    text = F.when((p["rank"] == 0) & p["other"].isNull(), p["whole"].cast("string")).when(p["other"].isNotNull(), wide).otherwise(exact)
    return F.when((p["n"] > 0) & ~p["odd"], literal(text, datatype=_type(p["rank"])))


def _weight(text: Column) -> tuple[Column, Column]:
    """The place of a whole number's first group of four digits, and the group."""
    place = F.floor((F.char_length(text) - 1) / 4).cast("int")
    return place, F.substring(text, F.lit(1), F.char_length(text) - 4 * place).cast("int")


def _divided(s: Column, t: Column, f: Column, n: Column, p: Column) -> Column:
    """(t.f) / n by long division to 28 places, rounded to so many that there are 16 significant digits or more: groups of
    four digits count as a whole, and the inputs' own places are kept."""
    minus = lambda a, b: (a - b).cast(INTEGER)
    rest = (t % n).cast(INTEGER)
    first = (rest * F.lit(str(10**18)).cast("decimal(19,0)")).cast(INTEGER) + f
    ten = F.lit(10**10).cast("decimal(11,0)")

    def places(v: Column) -> Column:
        a = v["first"]
        left = (a % n).cast("decimal(18,0)")
        second = (left * ten).cast("decimal(29,0)")
        high, low = (minus(a, left) / n).cast("decimal(19,0)"), ((second - second % n).cast("decimal(29,0)") / n).cast("decimal(10,0)")
        return let(F.struct((minus(t, v["rest"]) / n).cast("decimal(32,0)").alias("q"), (high.cast("decimal(27,0)") * ten + low).cast(INTEGER).alias("f")), written)

    def written(v: Column) -> Column:
        text, count = t.cast("string"), n.cast("string")
        fraction = F.lpad(f.cast("string"), 18, "0")
        zeros = F.char_length(F.regexp_extract(F.concat(fraction, F.lit("00")), "^(?:0000)*", 0))
        w1, d1 = _weight(text)
        w1, d1 = F.when(t == 0, F.when(f == 0, 0).otherwise(-(zeros / 4).cast("int") - 1)).otherwise(w1), F.when(t == 0, F.when(f == 0, 0).otherwise(F.substring(F.concat(fraction, F.lit("00")), zeros + 1, F.lit(4)).cast("int"))).otherwise(d1)
        w2, d2 = _weight(count)
        wanted = F.least(F.greatest(16 - 4 * (w1 - w2 - F.when(d1 <= d2, 1).otherwise(0)), p["scale"], F.lit(0)), F.lit(PLACES - 1))
        half = F.concat(F.lit("5"), F.repeat(F.lit("0"), PLACES - 1 - wanted)).cast(INTEGER)
        return let(F.struct((v["f"] + half).cast(INTEGER).alias("f"), wanted.alias("k")), lambda u: rounded(v["q"], u["f"], u["k"]))

    def rounded(q: Column, up: Column, k: Column) -> Column:
        over = up >= F.lit(str(10**PLACES)).cast("decimal(29,0)")
        head = F.when(over, q + 1).otherwise(q).cast("decimal(33,0)").cast("string")
        tail = F.substring(F.lpad(F.when(over, up - F.lit(str(10**PLACES)).cast("decimal(29,0)")).otherwise(up).cast(INTEGER).cast("string"), PLACES, "0"), F.lit(1), k)
        whole = (p["rank"] == 0) & (rest == 0) & (f == 0)
        return F.concat(s, head, F.when(whole, F.lit(".0")).when(k > 0, F.concat(F.lit("."), tail)).otherwise(F.lit("")))

    return let(F.struct(first.cast(INTEGER).alias("first"), rest.alias("rest")), places)


def rdf_avg(x: Term, over: WindowSpec | None = None) -> Column:
    """Integers give decimals; a whole result prints as n.0 for integers; else 16 significant digits or more."""
    return _parts(x, over, _avg)


def _avg(p: Column) -> Column:
    n = p["n"].cast("decimal(18,0)")
    exact = F.when(n > 0, _total(p, lambda s, t, f: _divided(s, t, f, n, p)))
    text = F.when(p["other"].isNotNull(), _special((p["other"] + p["whole"].cast("double") + p["fraction"].cast("double")) / p["n"])).otherwise(exact)
    kind = F.when(p["rank"] == 0, F.lit(xsd("decimal"))).otherwise(_type(p["rank"]))
    return F.when((p["n"] > 0) & ~p["odd"], literal(text, datatype=kind))


def rdf_min(x: Term, over: WindowSpec | None = None) -> Column:
    x = _col(x)
    return _over(F.min_by(x, F.when(x.isNotNull(), sort_struct(x))), over)


def rdf_max(x: Term, over: WindowSpec | None = None) -> Column:
    x = _col(x)
    return _over(F.max_by(x, F.when(x.isNotNull(), sort_struct(x))), over)


def rdf_sample(x: Term, over: WindowSpec | None = None) -> Column:
    return _over(F.first(_col(x), ignorenulls=True), over)


def rdf_group_concat(x: Term, separator: str = " ", order: Column | None = None) -> Column:
    """Texts joined in `order` (of the texts where None); quotes escaped again; the empty text if there is nothing."""
    text = F.regexp_replace(string_form(x), r'(?<!\\)((?:\\\\)*)"', r'$1\\"')
    key = text if order is None else order
    rows = F.array_sort(F.collect_list(F.when(_col(x).isNotNull(), F.struct(key.alias("k"), text.alias("t")))))
    return F.when(F.size(rows) > 0, literal(F.array_join(F.transform(rows, lambda r: r["t"]), separator))).otherwise(F.lit(""))
