"""Writing triples: as new triple tables, and as SPARQL UPDATE text in batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

COLUMNS = ["subject", "predicate", "object"]
VARIABLE = re.compile(r"[?$]([A-Za-z_]\w*)")
BATCH = 50


def insert(triples: DataFrame, rows: DataFrame) -> DataFrame:
    """A set: what's there already isn't doubled."""
    return triples.select(*COLUMNS).unionByName(rows.select(*COLUMNS)).distinct()


def delete(triples: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with a null match nothing."""
    return triples.join(rows.select(*COLUMNS).dropna(), COLUMNS, "left_anti")


def update(triples: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    return insert(delete(triples, old), new)


def check_pattern(pattern: str, columns: Iterable[str]) -> list[str]:
    """The variables of an update pattern, each of which must be a column; it needs three parts at least."""
    body = re.sub(r'"(?:[^"\\]|\\.)*"|<[^>]*>', "x", pattern)
    if len([p for p in re.split(r"[\s{}.;]+", body) if p]) < 3:
        raise ValueError("an update pattern needs a subject, a predicate and an object")
    names = list(dict.fromkeys(VARIABLE.findall(re.sub(r'"(?:[^"\\]|\\.)*"|<[^>]*>', " ", pattern))))
    if missing := [n for n in names if n not in set(columns)]:
        raise ValueError(f"no column for ?{missing[0]}")
    return names


def escape(term: str) -> str:
    """Control characters of a term as escapes."""
    names = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: names.get(m[0], f"\\u{ord(m[0]):04X}"), term)


def fill(pattern: str, row: dict[str, str | None], skip_null: bool = False) -> str | None:
    """The pattern with the row's terms. A null: None with skip_null, else an error; blank nodes are errors."""
    names = VARIABLE.findall(pattern)
    for n in names:
        if row.get(n) is None:
            if skip_null:
                return None
            raise ValueError(f"?{n} is null")
        if row[n].startswith("_:"):
            raise ValueError(f"?{n} is a blank node")
    return VARIABLE.sub(lambda m: escape(row[m[1]]), pattern)


def statements(rows: Iterable[dict], pattern: str, kind: str = "insert", batch: int = BATCH) -> Iterator[str]:
    """SPARQL UPDATE texts of `batch` rows each. kind: insert, delete, or update with rows of {"old": ..., "new": ...}."""
    held: list[str] = []
    for row in rows:
        if kind == "update":
            held.append(f"DELETE DATA {{ {fill(pattern, row['old'])} }}; INSERT DATA {{ {fill(pattern, row['new'])} }};")
        elif (text := fill(pattern, row, skip_null=kind == "delete")) is not None:
            held.append(f"{kind.upper()} DATA {{ {text} }};")
        if len(held) >= batch:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def copy_from(*_) -> None:
    raise NotImplementedError("COPY FROM into a SPARQL table isn't supported; insert rows")
