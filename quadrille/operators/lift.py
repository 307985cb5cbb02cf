"""Relational tables as terms and triples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import literal, typed

BASE = "http://example.org/"


def node(kind: str, *keys: Column) -> Column:
    """<base/kind/k1-k2>; null if a key is."""
    joined = F.concat(*[c for k in keys for c in (F.lit("-"), k.cast("string"))][1:])
    return F.concat(F.lit(f"<{BASE}{kind}/"), joined, F.lit(">"))


def predicate(name: str) -> str:
    return f"<{BASE}p/{name}>"


def text(c: Column) -> Column:
    return literal(F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', r'\\"'))


def tagged(c: Column, tag: Column) -> Column:
    return F.concat(text(c), F.lit("@"), tag)


def integer(c: Column) -> Column:
    return typed(c.cast("decimal(38,0)").cast("string"), "integer")


def decimal(c: Column, scale: int = 2) -> Column:
    """Doubles go through a fixed scale, so that every engine prints the same."""
    return typed(c.cast(f"decimal(20,{scale})").cast("string"), "decimal")


def date_time(c: Column) -> Column:
    return typed(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), "dateTime")


def date(c: Column) -> Column:
    return typed(F.date_format(c, "yyyy-MM-dd"), "date")


def triples(df: DataFrame, subject: Column, **objects: Column) -> DataFrame:
    """(subject, predicate, object) of each row and named object; null objects are left out. One pass over the table."""
    pairs = F.array(*[F.struct(F.lit(predicate(p)).alias("predicate"), o.alias("object")) for p, o in objects.items()])
    rows = df.select(subject.alias("subject"), F.explode(pairs).alias("po"))
    return rows.select("subject", "po.predicate", "po.object").where("subject is not null and object is not null")


def union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
