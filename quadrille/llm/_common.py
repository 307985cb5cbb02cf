"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import functools
import operator
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the corpus contracts: runs of characters other than space and \t\n\v\f\r.
WORD_GAP = r"[\x20\x09-\x0D]+"
MASK64 = (1 << 64) - 1


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operator uses; others can't clash."""
    return df.select(*[df[f"`{name}`"].alias(alias) for alias, name in columns.items()])


def words_of(text: str) -> list[str]:
    """Words split at space and \\t\\n\\v\\f\\r alone (str.split() also splits at other blanks)."""
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    return [w for w in text.translate(_GAPS).split(" ") if w]


_GAPS = {c: " " for c in range(9, 14)}


def native_words(text: Column) -> Column:
    """The same words as a native array; empty for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


#: Rows and bytes of long texts that go to a Python worker at once.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def bound_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to sizes that suit whole texts. Results are lazy, so the settings have to stay."""
    for name, value in ARROW.items():
        spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Without spark.checkpoint.dir only a local master gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="quadrille-")
    spark.conf.set("spark.checkpoint.dir", own)
    spark.sparkContext.setCheckpointDir(own)
    return own


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/quadrille/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    spark = df.sparkSession
    df.write.parquet(path := new_path(spark, name))
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def join_hot(rows: DataFrame, table: DataFrame, on: list[str], count: str, how: str = "inner") -> DataFrame:
    """Inner or left join with a written table that has each key once and the number of its rows in a column.

    Keys with over a thousandth of all rows, of which there are fewer than a thousand, are broadcast, so that no task gets
    all rows of one; the others are shuffled. Give it rows that may be read twice.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    hot, cold = (table.where(f"{count} * 1000 {sign} {total}") for sign in (">", "<="))
    if hot.isEmpty():
        return rows.join(table, on, how)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(cold, on, how))


#: Hashes of keys that are broadcast, at most: 8 bytes each in the tasks' hash table.
MOST_BROADCAST = 1_000_000


def without(rows: DataFrame, gone: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose keys (the columns `on` names, with those of `gone`, a written table) aren't in it. Nulls equal each other.

    Up to MOST_BROADCAST keys are broadcast as 64-bit hashes, and only rows that these hit are shuffled, to compare the keys
    themselves; the other rows stay where they are. With more keys than that all rows are shuffled.
    """
    same = lambda df: functools.reduce(operator.and_, [df[f"`{mine}`"].eqNullSafe(gone[theirs]) for mine, theirs in on.items()])
    if gone.count() > MOST_BROADCAST:
        return rows.join(gone, same(rows), "left_anti")
    short = F.broadcast(gone.select(F.xxhash64(*on.values()).alias("_q_short")).distinct())
    rows = rows.withColumn("_q_hash", F.xxhash64(*[F.col(f"`{mine}`") for mine in on]))
    clear, hit = (rows.join(short, rows["_q_hash"] == short["_q_short"], how) for how in ("left_anti", "left_semi"))
    return clear.unionByName(hit.join(gone, same(hit), "left_anti")).drop("_q_hash")


def near(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is in `wanted`, a written table of distinct keys in one column; chance hits of the hash may come along.

    Up to MOST_BROADCAST keys are broadcast as 64-bit hashes, so that the rows stay where they are; more go through a shuffle.
    """
    if wanted.count() > MOST_BROADCAST:
        return rows.join(wanted.toDF(key), key, "left_semi")
    short = F.broadcast(wanted.select(F.xxhash64(wanted.columns[0]).alias("_q_short")))
    return rows.join(short, F.xxhash64(rows[key]) == short["_q_short"], "left_semi")
