"""Near-duplicate detection with SetSketch registers.

A document's set of shingles is turned into 256 registers. Every shingle sends exponentially spaced points to registers
drawn at random (the points of a register are then a Poisson process of rate A, so the least point of n shingles is
exponential with rate n*A), and a register holds the truncated logarithm, to a base near 1, of its least point. Registers
of a union are the maxima, and two sets agree in a register with a probability near their similarity. Points are made in
growing order and a shingle stops once its next point can't lower any register, so a set costs about its size plus
m log m steps rather than size times m.

1. Documents with equal sets are one node. 2. Up to eight registers a band, as many bands as that gives, by the
threshold (`banding`): documents that share a band are candidates (a pair at the threshold is missed once in 25,000 at
most; a pair that isn't may still meet in step 4). 3. Candidates' coarse components that are small are compared within one
task. 4. In a large one, every document is first verified against the least document of each of its buckets, one pair a
row; of a bucket, only those that this doesn't connect with most of it are compared with all of it, block by block, so a
group of n near copies takes about n comparisons. 5. Comparing two documents is a joint estimate of their similarity from
the registers where one is greater, less and equal, given both sizes: the likelihood's maximum. Pairs whose likelihood at
the threshold is far below it are ruled out, the rest, the likeliest first, are verified on full sets. Pairs that are
already connected need no look. 6. Verified links' components are the answer.

A task emits at most one edge a document. Joins by digest, band and hub broadcast their hot keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import join_hot, materialise, near, pick, without
from .components import components
from .hashing import chunks, mix, shingle_sets

WIDTH = 5
PERCENT = 85
REGISTERS = 256
#: Registers a band at most, and the share of pairs at the threshold that may share no band.
MOST_ROWS, MISSED = 8, 4e-5
# Fixed values of the sketch: base, rate and truncation.
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
#: Log-likelihood by which a pair must be worse at the threshold than at its best to be ruled out (once in a million).
DOUBT = 14.0
#: Shingles and documents that one task compares; larger groups are cut.
MOST_SHINGLES, MOST_NODES = 3_000_000, 3000
#: Pairs with one leader that go to one task.
PAIRS_A_TASK = 1000
#: Steps of the search for the likelihood's maximum; each narrows it to 0.62 of what it was.
STEPS = 20


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (uint16) of each set; all zero for an empty one."""
    n, m = len(sets), REGISTERS
    least = np.full(n * m, np.inf)
    h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    at = np.zeros(len(h))
    bound = np.full(n, np.inf)
    step = 0
    while len(h):
        draw = mix(h + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        at = at - np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / (m * RATE)
        alive = at < np.minimum(bound, 1.0)[owner]
        h, owner, at, draw = h[alive], owner[alive], at[alive], draw[alive]
        np.minimum.at(least, owner * m + (mix(draw) & np.uint64(m - 1)).astype(np.int64), at)
        step += 1
        if step & (step - 1) == 0 or step % 8 == 0:
            some = np.unique(owner)
            bound[some] = least.reshape(n, m)[some].max(axis=1)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(k, 0, LIMIT + 1).astype(np.uint16).reshape(n, m)


def banding(percent: int) -> tuple[int, int]:
    """Bands and registers a band: the longest bands that miss few enough of the pairs at the threshold."""
    for rows in range(MOST_ROWS, 1, -1):
        if (1 - (percent / 100) ** rows) ** (REGISTERS // rows) <= MISSED:
            return REGISTERS // rows, rows
    return REGISTERS, 1


def band_keys(registers: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    bands, rows = banding(percent)
    padded = np.zeros((len(registers), bands, -(-rows // 4) * 4), np.uint16)
    padded[:, :, :rows] = registers[:, : bands * rows].reshape(len(registers), bands, rows)
    halves = padded.view(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), halves.shape[:2])
    for k in range(halves.shape[2]):
        key = mix(key + halves[:, :, k])
    return key.astype(np.int64)


def _agree(j: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities that one register is greater, and less, for shares u and 1 - u of the two sizes."""
    c = (BASE - 1) / BASE
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * c) / np.log(BASE)
    return p(u - (1 - u) * j), p((1 - u) - u * j)


def log_likelihood(j: np.ndarray, u: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    a, b = (np.clip(x, 1e-9, 1) for x in _agree(j, u))
    return more * np.log(a) + less * np.log(b) + (REGISTERS - more - less) * np.log(np.clip(1 - a - b, 1e-9, 1))


def estimate(u: np.ndarray, top: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """The similarity of maximum likelihood, by golden section (the logarithm has one peak between 0 and top)."""
    g = (np.sqrt(5) - 1) / 2
    low, high = np.zeros(len(u)), top.copy()
    a, b = high - g * (high - low), low + g * (high - low)
    at_a, at_b = log_likelihood(a, u, more, less), log_likelihood(b, u, more, less)
    for _ in range(STEPS):
        left = at_a >= at_b
        low, high = np.where(left, low, a), np.where(left, b, high)
        new = np.where(left, high - g * (high - low), low + g * (high - low))
        at_new = log_likelihood(new, u, more, less)
        a, b, at_a, at_b = np.where(left, new, b), np.where(left, a, new), np.where(left, at_new, at_b), np.where(left, at_a, at_new)
    return (low + high) / 2


def plausible(mine: np.ndarray, theirs: np.ndarray, size: int, sizes: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of `theirs` may have the similarity, by number, and the estimate of each of these."""
    more, less = (mine > theirs).sum(axis=1), (mine < theirs).sum(axis=1)
    u = size / (size + sizes)
    top = np.minimum(u / (1 - u), (1 - u) / u)  # of the similarity, for these sizes
    wanted = np.minimum(np.full(len(u), least), top)
    at_wanted = log_likelihood(wanted, u, more, less)
    # any point's likelihood is a lower bound of the maximum, so most are ruled out before it is searched
    near = np.minimum((REGISTERS - more - less) / REGISTERS, top)
    some = np.flatnonzero((near >= wanted) | (at_wanted >= log_likelihood(near, u, more, less) - DOUBT))
    best = estimate(u[some], top[some], more[some], less[some])
    may = (best >= wanted[some]) | (at_wanted[some] >= log_likelihood(best, u[some], more[some], less[some]) - DOUBT)
    return some[may], best[may]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the similarity."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return False
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def link(ids: np.ndarray, sets: list[np.ndarray], registers: np.ndarray, percent: int = PERCENT, sides: np.ndarray | None = None) -> np.ndarray:
    """The least id that each document is connected with inside this group; equal ids are connected from the start. With
    `sides` only pairs across them count."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    order, label = np.unique(ids, return_inverse=True)  # by the order of ids; the least label is the least id
    for i in range(n):
        rest = np.arange(i + 1, n)
        rest = rest[(label[rest] != label[i]) & (100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i]))]
        if sides is not None:
            rest = rest[sides[rest] != sides[i]]
        if not len(rest):
            continue
        may, best = plausible(registers[i], registers[rest], int(sizes[i]), sizes[rest], percent / 100)
        for k in rest[may][np.argsort(-best, kind="stable")]:
            if label[k] != label[i] and similar(sets[i], sets[k], percent):
                low, high = sorted((label[i], label[k]))
                label[label == high] = low
    return order[label]


def signatures(df: DataFrame, id_col: str, text_col: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, digest of the set, its band keys (none for an empty set).

    Null and empty texts have empty sets; repeated rows and null ids are kept; an empty table gives none.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part in chunks(batch.column(1)):
                sets = shingle_sets([t.lower() for t in part], width)  # of bytes: A-Z alone
                keys = band_keys(sketch(sets), percent)
                sizes = [len(s) for s in sets]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                bands = [k if len(s) else [] for s, k in zip(sets, keys)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(part)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "bands"])
                row += len(part)

    return pick(df, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, n_shingles long, digest binary, bands array<long>")


def sets_of(df: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, shingles, registers) of the documents that are nodes; a chance hit of an id's hash may add others, which the joins
    with nodes leave out."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part in chunks(batch.column(1)):
                sets = shingle_sets([t.lower() for t in part], width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(part)), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([r.tobytes() for r in sketch(sets)], pa.binary())], names=["node", "shingles", "registers"])
                row += len(part)

    texts = near(pick(df, node=id_col, text=text_col), "node", materialise(nodes.select("node").distinct(), "near-wanted"))
    return texts.mapInArrow(run, f"node {kind}, shingles binary, registers binary")


def buckets(nodes: DataFrame) -> DataFrame:
    """(node, band, least) of the bands that several nodes share. A band of two is known from its least and greatest node;
    only those of more are joined with the nodes again."""
    keys = nodes.select("node", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most"), F.count("*").alias("n")).where("least != most")
    shared = materialise(shared, "near-shared")
    two = shared.where("n = 2").select(F.explode(F.array("least", "most")).alias("node"), "band", "least")
    more = shared.where("n > 2").drop("most")
    many = join_hot(near(keys, "band", more.select("band")), more, ["band"], "n").select("node", "band", "least")
    return materialise(two.unionByName(many), "near-buckets")


def leader_links(big: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) from nodes to the least ones of their buckets, verified; a leader of many is dealt out by salt."""
    kind = big.schema["node"].dataType.simpleString()
    pairs = big.where("node != least").select("node", F.col("least").alias("leader")).distinct()
    salts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / PAIRS_A_TASK).cast("int").alias("salts"))
    mine = pairs.join(sets.select("node", "shingles"), "node").withColumn("deal", F.xxhash64("node"))
    leaders = salts.join(sets.select(F.col("node").alias("leader"), F.col("shingles").alias("theirs")), "leader").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    most = salts.agg(F.max("salts")).first()[0] or 1
    if most > 1:  # each pair needs its leader's number of salts; those of leaders with several are few
        several = F.broadcast(salts.where("salts > 1"))  # at most a thousandth of the pairs, 12 bytes each
        mine = mine.join(several, "leader", "left").withColumn("salt", F.pmod("deal", F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    else:
        mine = mine.withColumn("salt", F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [similar(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64), percent) for a, b in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(hit, pa.bool_()))

    both = mine.join(leaders.drop("salts"), ["leader", "salt"]).select("node", "leader", "shingles", "theirs")
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def group(of: str | Column, i: Column | int = -1, j: Column | int = -1) -> Column:
    return F.struct((F.lit(of) if isinstance(of, str) else of).alias("of"), (F.lit(i) if isinstance(i, int) else i).cast("int").alias("i"), (F.lit(j) if isinstance(j, int) else j).cast("int").alias("j")).alias("grp")


def block_groups(big: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label, grp, side): for each bucket the comparisons that are left once `labels` (node, label) are connected.

    Nodes of the label that most of the bucket has are settled, the others open. A bucket without open nodes needs nothing;
    a small one is one group; else open blocks are paired with all blocks, settled ones with open ones alone.
    """
    rows = big.join(labels, "node")
    first = rows.groupBy("band", "label").agg(F.count("*").alias("n")).groupBy("band").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"))
    first = materialise(first.select("band", F.col("top.label").alias("settled"), "n"), "near-settled")
    rows = materialise(join_hot(rows, first, ["band"], "n").withColumn("open", F.col("label") != F.col("settled")).drop("n", "settled", "least"), "near-big")
    need = lambda o: F.greatest(F.ceil(F.sum(F.when(o, F.col("n_shingles"))) * 2 / MOST_SHINGLES), F.ceil(F.count(F.when(o, 1)) * 2 / MOST_NODES), F.lit(0)).cast("int")
    load = rows.groupBy("band").agg(need(F.col("open")).alias("opens"), need(~F.col("open")).alias("settles"), F.count("*").alias("n")).where("opens > 0")
    cut = join_hot(rows, materialise(load, "near-load"), ["band"], "n").drop("n")
    small = F.col("opens") + F.col("settles") <= 2
    name = F.concat(F.lit("b"), F.col("band"))
    one = cut.where(small).select("node", "label", group(name), F.lit(-1).alias("side"))
    large = cut.where(~small).withColumn("mine", F.pmod(F.xxhash64("node", F.lit(17)), F.greatest(F.when(F.col("open"), F.col("opens")).otherwise(F.col("settles")), F.lit(1))).cast("int"))
    other = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("opens") - 1)))
    among = other.where("open").select("node", "label", group(name, F.least("mine", "other"), F.greatest("mine", "other")), F.when(F.col("mine") == F.col("other"), -1).otherwise(F.col("mine")).alias("side"))
    name = F.concat(F.lit("s"), F.col("band"))
    settled = other.where("not open").select("node", "label", group(name, F.col("mine"), F.col("other")), F.lit(0).alias("side"))
    against = large.where("open and settles > 0").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("settles") - 1))).select("node", "label", group(name, F.col("other"), F.col("mine")), F.lit(1).alias("side"))
    return one.unionByName(among).unionByName(settled).unionByName(against)


def links(sets: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) from the label of each candidate (node, label, grp, side) to the least one that it is connected with
    in a group. Nodes with empty sets must not be among them; repeated edges may come out."""
    kind = groups.schema["label"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            ids = np.array([r[0] for r in rows])
            sides = np.array([r[3] for r in rows])
            found = link(ids, [np.frombuffer(r[1], np.uint64) for r in rows], np.frombuffer(b"".join([r[2] for r in rows]), np.uint16).reshape(len(rows), REGISTERS), percent, sides if (sides >= 0).any() else None)
            far = found != ids
            return pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(found[far])], schema=schema)

        schema, key, rows = None, None, []
        for batch in batches:
            schema = schema or pa.schema([("a", batch.schema.field("label").type), ("b", batch.schema.field("label").type)])
            for grp, *row in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("grp", "label", "shingles", "registers", "side")]):
                if grp != key and rows:
                    yield done(rows)
                    rows = []
                key = grp
                rows.append(tuple(row))
        if rows:
            yield done(rows)

    rows = sets.join(groups, "node").select("grp", "node", "label", "shingles", "registers", "side")
    return rows.repartition("grp").sortWithinPartitions("grp", "node").mapInArrow(compare, f"a {kind}, b {kind}")


def candidate_links(df: DataFrame, nodes: DataFrame, id_col: str, text_col: str, percent: int, width: int) -> DataFrame:
    """Edges (a, b) between nodes (node, n_shingles, bands) of other sets; their components are those of all links."""
    held = buckets(nodes)
    coarse = materialise(components(held.select(F.col("node").alias("a"), F.col("least").alias("b"))), "near-coarse")
    sizes = nodes.select("node", "n_shingles").join(coarse, "node")
    weight = sizes.groupBy("component").agg(F.sum("n_shingles").alias("shingles"), F.count("*").alias("n"))
    large = materialise(weight.where((F.col("shingles") > MOST_SHINGLES) | (F.col("n") > MOST_NODES)).select("component"), "near-large")  # at most a thousandth of the nodes, and such as have many shingles
    whole = sizes.join(large, "component", "left_anti").select("node", F.col("node").alias("label"), group(F.col("component").cast("string")), F.lit(-1).alias("side"))
    if large.isEmpty():
        groups = materialise(whole, "near-groups")
        return links(sets_of(df, groups, id_col, text_col, width), groups, percent)
    members = materialise(coarse.join(large, "component", "left_semi").select("node"), "near-members")
    big = held.join(members.join(nodes.select("node", "n_shingles"), "node"), "node")
    sets = materialise(sets_of(df, sizes, id_col, text_col, width), "near-sets")
    led = materialise(leader_links(big, sets, percent), "near-led")
    found = components(led)
    labels = members.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("label"))
    groups = materialise(whole.unionByName(block_groups(big, materialise(labels, "near-labels"))), "near-groups")
    return links(sets, groups, percent).unionByName(led)


def near_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the least id reachable), kept (doc_id is that id).

    Null and empty texts and texts without words have empty sets and are linked with nothing. Rows that share an id are
    one document with several sets. Rows without an id are linked with nothing and kept; their component is null. Ties
    can't arise; an empty table gives none; other columns are ignored.
    """
    rows = materialise(signatures(df, id_col, text_col, width, percent), "near-rows")
    some = rows.where("n_shingles > 0 and doc_id is not null")
    first = materialise(some.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")), "near-first")
    known = materialise(join_hot(some, first, ["digest"], "n").drop("n"), "near-nodes")
    edges = candidate_links(df, known.where("doc_id = node").select("node", "n_shingles", "bands"), id_col, text_col, percent, width)
    same = known.where("doc_id != node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(edges.union(same))
    joined = rows.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each component, with the columns it came with; of rows that share an id, the one whose text has the least
    hash. Rows without an id, and those with empty sets, stay; an empty table gives none."""
    gone = materialise(near_components(df, id_col, text_col, percent), "near-marks").groupBy("doc_id").agg(F.count("*").alias("_n"), F.min("kept").alias("_kept")).where("doc_id is not null and (not _kept or _n > 1)")
    gone = materialise(gone, "near-gone")
    repeated = gone.where("_kept")
    key = F.col(f"`{id_col}`")
    left = without(df, gone.select(F.col("doc_id").alias("_q_id")), {id_col: "_q_id"})
    if repeated.isEmpty():
        return left
    one = Window.partitionBy(key).orderBy(F.xxhash64(F.col(f"`{text_col}`")))
    again = df.join(repeated.select(F.col("doc_id").alias("_q_id")), key == F.col("_q_id"), "left_semi").withColumn("_q_k", F.row_number().over(one)).where("_q_k = 1").drop("_q_k")
    return left.unionByName(again)
