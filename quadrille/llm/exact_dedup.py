"""Exact deduplication as a stateful stream.

`groups_of` is the streaming operator: keyed state in RocksDB on disk, without a watermark and so without expiry, holds
for each digest the stable identifier of the row to keep, its locator, the locator of the content that was met first, and
the number of rows. A locator is a file and a row in it, so content is found again by it. It takes any stream of records
(digest, n_bytes, doc_id, locator). `group_table` feeds it the records of a table, some files a round, and leaves the
groups as a table. A digest met again is only a hit: in the batch that met it, the full bytes of the batch's rows with that
digest are compared with the content that the state points to (as least and greatest text per digest, combined before the
shuffle, so a text that a third of the rows share moves once a task). Should two texts ever share a digest, their rows are
grouped by the texts themselves.

Of equal texts the row with the largest id stays; null texts count as empty, null ids as smaller than any; of rows that
share both, one stays.
"""

from __future__ import annotations

import contextlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import MOST_BROADCAST, join_hot, materialise, new_path, without

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Files whose rows are taken in by a round, about.
FILES_PER_ROUND = 4096
#: Plans whose rows are rows of files, one for one.
_OF_FILES = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def digest_of(text: Column) -> Column:
    return F.sha2(text, 256)


def _is_of_files(df: DataFrame) -> bool:
    todo = [df._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() not in _OF_FILES:
            return False
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return "_metadata" not in df.columns


def content_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", files_per_round: int = FILES_PER_ROUND) -> tuple[DataFrame, int]:
    """(doc_id, text, locator), and the number of rounds. What isn't a plain read of Parquet files is written to some first."""
    rows = df.select(df[f"`{id_col}`"].alias("doc_id"), F.coalesce(df[f"`{text_col}`"], F.lit("")).alias("text"))
    located = None
    if _is_of_files(df):
        with contextlib.suppress(AnalysisException):  # files of another format have no row numbers
            located = rows.select("*", "_metadata.file_path", "_metadata.row_index")
            located.schema  # noqa: B018
    if located is None:
        located = materialise(rows, "dedup-content").select("*", "_metadata.file_path", "_metadata.row_index")
    rounds = -(-len(located.inputFiles()) // files_per_round) or 1
    file = F.xxhash64("file_path")
    return located.select("doc_id", "text", F.struct(F.pmod(file, F.lit(rounds)).cast("int").alias("round"), file.alias("file"), F.col("row_index").alias("row")).alias("locator")), rounds


def records(content: DataFrame) -> DataFrame:
    return content.select("doc_id", digest_of(F.col("text")).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), "locator")


def groups_of(stream: DataFrame) -> DataFrame:
    """Per digest and length: keep (identifier and locator of the row to keep), at (locator of the first content) and
    group_size. For streams in update mode; rounds come in order, so the first content stays the first."""
    return stream.groupBy("digest", "n_bytes").agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.min("locator").alias("at"), F.count("*").alias("group_size"))


@contextlib.contextmanager
def _settings(spark: SparkSession, **values: str):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def group_table(content: DataFrame, rounds: int, path: str) -> tuple[DataFrame, DataFrame]:
    """Groups of the content's rows, whose records are written under `path`, and the digests that several texts share."""
    spark = content.sparkSession
    schema = records(content).schema
    out, clashed, state = (new_path(spark, f"dedup-{name}") for name in ("groups", "clashes", "state"))
    empty = spark.createDataFrame([], schema)
    groups_of(empty).withColumn("batch", F.lit(0).cast("long")).write.parquet(out)
    empty.select("digest").write.parquet(clashed)

    def take(part: DataFrame, k_round: int):
        def run(batch: DataFrame, k: int) -> None:
            batch.withColumn("batch", F.lit(k).cast("long")).write.mode("append").parquet(out)
            hits = spark.read.parquet(out).where(f"batch = {k} and group_size > 1").select("digest", "at")
            clashing(content, part, hits, k_round).write.mode("append").parquet(clashed)

        return run

    with _settings(spark, **{"spark.sql.streaming.stateStore.providerClass": PROVIDER, "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false", "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true", "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256"}):
        for k in range(rounds):
            part = content.where(F.col("locator.round") == k) if rounds > 1 else content
            records(part).write.mode("append").parquet(path)
            stream = spark.readStream.schema(schema).parquet(path)
            query = groups_of(stream).writeStream.outputMode("update").foreachBatch(take(part, k)).option("checkpointLocation", state).trigger(availableNow=True).start()
            query.awaitTermination()
    # a batch that was run again, or a digest in several batches: its last state counts
    last = spark.read.parquet(out).groupBy("digest", "n_bytes").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))
    return last, spark.read.parquet(clashed).distinct()


def clashing(content: DataFrame, part: DataFrame, hits: DataFrame, k_round: int = 0) -> DataFrame:
    """Digests of hits (digest, at) of which a row of the round's part has other bytes than the content at the locator.

    Where the locator points to an earlier round, that content is fetched; else it's one of the part's rows. Up to
    MOST_BROADCAST hits (8 bytes each) are sent to the tasks, so that only hits' texts move; beyond that the texts are
    joined with them by a shuffle. A chance hit of the short hash only adds a row to the comparison.
    """
    near = F.broadcast if hits.count() <= MOST_BROADCAST else (lambda df: df)
    texts = part.select(digest_of(F.col("text")).alias("digest"), "text").withColumn("short", F.xxhash64("digest"))
    texts = texts.join(near(hits.select(F.xxhash64("digest").alias("short"))), "short", "left_semi").select("digest", "text")
    if k_round:
        before = hits.where(F.col("at.round") < k_round)
        known = content.where(F.col("locator.round") < k_round).withColumn("short", F.xxhash64("locator.file", "locator.row"))
        known = known.join(near(before.select(F.xxhash64("at.file", "at.row").alias("short"))), "short", "left_semi")
        texts = texts.unionByName(known.select(digest_of(F.col("text")).alias("digest"), "text"))
    return texts.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a != b").select("digest")


def mark(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", files_per_round: int = FILES_PER_ROUND) -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256.

    An empty table gives none; other columns are ignored.
    """
    spark = df.sparkSession
    path = new_path(spark, "dedup-records")
    content, rounds = content_of(df, id_col, text_col, files_per_round)
    groups, clashes = group_table(content, rounds, path)
    table = spark.read.schema(records(content).schema).parquet(path)
    repeated = materialise(groups.where("group_size > 1").select("digest", "n_bytes", F.col("keep.doc_id").alias("keep_id"), F.col("keep.locator").alias("keep_at"), "group_size"), "dedup-repeated")
    on = ["digest", "n_bytes"]
    if clashes.isEmpty():
        joined = join_hot(table, repeated, on, "group_size", "left")
    else:  # digests of several texts: tell them apart by the texts
        clashes = materialise(clashes, "dedup-clashing")
        odd = materialise(content.withColumns({"digest": digest_of(F.col("text")), "n_bytes": F.octet_length("text").cast("long")}).join(clashes, "digest", "left_semi"), "dedup-odd")
        split = odd.groupBy(*on, "text").agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.count("*").alias("group_size"))
        split = materialise(split.select(*on, "text", F.col("keep.doc_id").alias("keep_id"), F.col("keep.locator").alias("keep_at"), "group_size"), "dedup-split")
        plain = join_hot(table.join(clashes, "digest", "left_anti"), repeated, on, "group_size", "left")
        joined = plain.unionByName(join_hot(odd, split, [*on, "text"], "group_size").drop("text"))
    alone = F.col("keep_at").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("locator") == F.col("keep_at"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with.

    Of rows that share id and text any one stays: they differ in other columns at most. An empty table gives none.
    """
    marked = materialise(mark(df, id_col, text_col), "dedup-marks")
    gone = marked.where("not kept").select(F.col("doc_id").alias("_q_id"), F.col("text_sha256").alias("_q_digest"), (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("_q_twin")).distinct()
    gone = materialise(gone, "dedup-gone")
    rows = df.withColumn("_q_text_digest", digest_of(F.coalesce(df[f"`{text_col}`"], F.lit(""))))
    same = rows[f"`{id_col}`"].eqNullSafe(gone["_q_id"]) & (rows["_q_text_digest"] == gone["_q_digest"])
    twins = gone.where("_q_twin")
    left = without(rows, gone, {id_col: "_q_id", "_q_text_digest": "_q_digest"})
    if not twins.isEmpty():  # rows that share id and text: one of them
        one = Window.partitionBy(F.col(f"`{id_col}`"), "_q_text_digest").orderBy("_q_text_digest")
        left = left.unionByName(rows.join(twins, same, "left_semi").withColumn("_q_k", F.row_number().over(one)).where("_q_k = 1").drop("_q_k"))
    return left.drop("_q_text_digest")
