"""Graph patterns over a triple table (subject, predicate, object), as DataFrame joins.

The local stand-in for a remote store: basic patterns, OPTIONAL, UNION, MINUS and filters. Variables are columns; shared
ones join by term identity, so Catalyst picks the join and pushes the patterns' constants into the scans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES = ("subject", "predicate", "object")


def match(triples: DataFrame, s: str, p: str, o: str) -> DataFrame:
    """One triple pattern: `?name` binds, anything else is a constant term."""
    out, seen = triples, {}
    for place, want in zip(PLACES, (s, p, o)):
        if not want.startswith("?"):
            out = out.where(F.col(place) == want)
        elif want[1:] in seen:
            out = out.where(F.col(place) == F.col(seen[want[1:]]))
        else:
            seen[want[1:]] = place
    return out.select(*[F.col(place).alias(name) for name, place in seen.items()])


def join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    shared = [c for c in a.columns if c in b.columns]
    return a.join(b, shared, how) if shared else a.crossJoin(b) if how == "inner" else a.join(b, F.lit(True), how)


def bgp(triples: DataFrame, *patterns: tuple[str, str, str]) -> DataFrame:
    """A basic graph pattern. Order patterns so that each shares a variable with one before it."""
    return reduce(join, [match(triples, *p) for p in patterns])


def star(triples: DataFrame, subject: str = "s", **objects: str) -> DataFrame:
    """Several predicates of one subject with one value each, by one shuffle instead of a join for each.

    Keyword: variable name; value: predicate term. Subjects without all of them are left out. Of several values the least counts.
    """
    wanted = triples.where(F.col("predicate").isin(*objects.values()))
    columns = [F.min(F.when(F.col("predicate") == p, F.col("object"))).alias(name) for name, p in objects.items()]
    return wanted.groupBy(F.col("subject").alias(subject)).agg(*columns).dropna()


def optional(a: DataFrame, b: DataFrame) -> DataFrame:
    return join(a, b, "left")


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    shared = [c for c in a.columns if c in b.columns]
    return a.join(b, shared, "left_anti") if shared else a


def describe(triples: DataFrame, *nodes: str) -> DataFrame:
    """Triples whose subject is one of the nodes."""
    return triples.where(F.col("subject").isin(*nodes))


