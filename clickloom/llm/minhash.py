"""Near-duplicate groups by fast similarity sketches, banding and exact verification.

1. Every text becomes its set of word shingles, a digest of the set, and the keys of its sketch's bands.
   Texts with equal sets are one node, named by the smallest id among them, before anything else is done.
2. Nodes that share a band key meet in a bucket. Each is paired with the bucket's smallest node, so a
   bucket gives as many pairs as it has members. Pairs are verified on the full sets; the links that hold
   make components.
3. What the stars could miss is left in buckets whose members are still in several components. Their
   members are packed into blocks of a bounded number of shingles and of sets of about one size; blocks of a
   bucket whose sizes leave room for the threshold are compared two by two inside tasks: sketches first, then
   full sets. Only links leave the tasks. Blocks within one component are not compared.
4. The components of all links are the groups; each document gets the smallest id of its group.

No bucket, group or set is capped or sampled. Numbers of bands and rows follow from the threshold: a pair
at the threshold misses all bands with a probability of at most 1e-5, and more similar ones much less.
Before sets are moved, sketches rule out pairs whose estimate is so low that one at the threshold has it
with a probability of at most 1e-7, by the binomial tail; the bands are nearly all of the loss.

Null or empty texts, and those of white space alone, have no shingles and are linked with nothing. Rows
without an id are returned as they are, without a component, and kept. Rows with one id are one document:
it has the links of all its texts, and each row the size of its own set. Ties don't arise, as groups
depend on links alone. An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import BROADCAST_BYTES, emit, fresh_name, join_keys, map_arrow, shuffle_partitions
from clickloom.llm.shingles import band_keys, shingle_set, similarity_sketch
from clickloom.sources.tables import materialize

#: Chance that a pair just at the threshold shares no band.
MISSED = 1e-5
#: Shingles of a block; a document counts as LEAST at least.
BLOCK, LEAST = 65_536, 512
#: Chance that the sketches of a pair just at the threshold rule it out.
RULED_OUT = 1e-7


def banding(threshold: float) -> tuple[int, int]:
    """Bands and rows per band."""
    rows = max(2, round(1 / max(1 - threshold, 0.02)))
    return math.ceil(math.log(MISSED) / math.log(1 - threshold**rows)), rows


def describe(docs: DataFrame, key: str, text: str, threshold: float, words: int) -> DataFrame:
    """id, n (set size), digest of the set and band keys of every row; the last two null for empty sets."""
    bands, rows = banding(threshold)

    def one(key: object, text: str | None) -> tuple:
        elements = shingle_set(text or "", words)
        if not len(elements):
            return key, 0, None, None
        keys = band_keys(similarity_sketch(elements, bands * rows), rows)
        return key, len(elements), xxhash.xxh3_128_digest(elements.tobytes()), keys.view(np.int64).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64()))])
        for batch in batches:
            found = (one(k.as_py(), t.as_py()) for k, t in zip(*batch.columns))
            yield from emit(found, schema, lambda row: 8 * bands + 64)

    return map_arrow(docs.select(F.col(key).cast("long"), F.col(text)), run, "id long, n long, digest binary, keys array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, key: str, text: str, threshold: float, words: int) -> DataFrame:
    """node, n, shingles and band keys (binary) and sketch (one byte a coordinate) of the documents in ``nodes``."""
    bands, rows = banding(threshold)

    def one(key: int, text: str | None) -> tuple:
        elements = shingle_set(text or "", words)
        if not len(elements):
            return key, 0, b"", b"", b""
        sketch = similarity_sketch(elements, bands * rows)
        keys = band_keys(sketch, rows)
        return key, len(elements), elements.tobytes(), sketch.astype(np.uint8).tobytes(), keys.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary()), ("sketch", pa.binary()), ("keys", pa.binary())])
        for batch in batches:
            yield from emit((one(k.as_py(), t.as_py()) for k, t in zip(*batch.columns)), schema, lambda row: len(row[2]) + 500)

    own = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    own = join_keys(own, nodes, "node", "left_semi")
    found = map_arrow(own, run, "node long, n long, shingles binary, sketch binary, keys binary")
    return found.where(F.col("n") > 0)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``percent`` or more."""
    low, high = sorted((len(a), len(b)))
    if 100 * low < percent * high:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def least_equal(threshold: float) -> int:
    """Equal coordinates below which a pair is not verified: one at the threshold has fewer with a chance of at most 1e-7."""
    bands, rows = banding(threshold)
    n, below, k = bands * rows, 0.0, 0
    while True:
        below += math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k)
        if below > RULED_OUT:
            return k
        k += 1


def least_estimate(threshold: float) -> float:
    """The share of equal coordinates just below that number of them."""
    bands, rows = banding(threshold)
    return (least_equal(threshold) - 0.5) / (bands * rows)


def promising(pairs: DataFrame, sets: DataFrame, threshold: float, percent: int) -> DataFrame:
    """The pairs whose sizes and sketches leave room for a similarity of ``percent``."""
    least = least_estimate(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
            near = pa.array((x == y).mean(1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("x"))
    other = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("y"))
    sized = pairs.join(one, "a").join(other, "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return map_arrow(sized.select("a", "b", "x", "y"), run, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, threshold: float, percent: int) -> DataFrame:
    """The pairs (a, b) that hold on their full sets; only sets of promising pairs are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for a, b, x, y in zip(*(c for c in batch.columns)):
                left, right = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                if similar(left, right, percent):
                    held.append((a.as_py(), b.as_py()))
            if held:
                yield pa.RecordBatch.from_pydict({"a": pa.array([h[0] for h in held]), "b": pa.array([h[1] for h in held])})

    fits = materialize(promising(pairs, sets, threshold, percent), "near-promising")

    def sets_of(side: str, name: str) -> DataFrame:
        used = materialize(fits.select(F.col(side).alias("node")).distinct(), "near-used")
        return join_keys(sets.select("node", "shingles"), used, "node", "left_semi").withColumnsRenamed({"node": side, "shingles": name})

    joined = fits.join(sets_of("a", "x"), "a").join(sets_of("b", "y"), "b").select("a", "b", "x", "y")
    return map_arrow(joined, run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all nodes in ``links`` (a, b).

    Large and small stars in turn: every node's larger neighbours, then its smaller ones, are tied to its
    smallest neighbour, until nothing changes. Minima are written down before they are joined: within the
    bound they are broadcast and edges stay in place, beyond it both sides come straight from a shuffle and a
    node with very many neighbours is split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "component-edges")
    before = None
    while True:
        sums = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not sums["n"] or sums == before:
            break
        before = sums
        small = 2 * sums["n"] * 32 <= BROADCAST_BYTES  # no more nodes than ends of edges

        def hinted(least: DataFrame) -> DataFrame:
            return F.broadcast(least) if small else least

        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "component-least")
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(hinted(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not small:
            large = materialize(large.distinct(), "component-large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "component-least")
        tied = large.join(hinted(least), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "component-edges")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return materialize(ends.unionByName(roots), "components")


def crowds(members: DataFrame, heads: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """key, node, component, n, class and block of the members of buckets that hold several components.

    Sets of one class are at most as far apart in size as the threshold allows, and those two classes apart are
    farther. A component of more than a block's shingles of a class has blocks of its own; others share blocks.
    Blocks come from sums and hashes, so no bucket is sorted or numbered in one task.
    """
    wide = materialize(heads.where("m > 2").select("key"), "near-wide")
    found = join_keys(members, wide, "key", "left_semi")
    own = groups.withColumnRenamed("component", "c")
    found = found.join(own, "node", "left").select("key", "node", "n", F.coalesce("c", "node").alias("component"))
    found = materialize(found, "near-members")
    mixed = found.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    mixed = materialize(mixed.select("key"), "near-mixed")
    found = materialize(join_keys(found, mixed, "key", "left_semi"), "near-crowds")
    weight = F.greatest(F.col("n"), F.lit(LEAST))
    found = found.withColumn("class", size_class(F.col("n"), percent))
    sums = found.groupBy("key", "class", "component").agg(F.sum(weight).alias("w"))
    shared = sums.where(F.col("w") <= BLOCK).groupBy("key", "class").agg(F.sum("w").alias("all_w"))
    sums = materialize(sums.join(shared, ["key", "class"], "left"), "near-weights")
    parts = F.ceil(F.col("w") / BLOCK)
    mixed_parts = F.ceil(2 * F.col("all_w") / BLOCK)
    block = F.when(
        F.col("w") > BLOCK, F.concat_ws("/", F.col("component"), F.pmod(F.xxhash64("node"), parts))
    ).otherwise(F.concat_ws("/", F.lit("s"), F.pmod(F.xxhash64("component"), mixed_parts)))
    blocked = found.join(sums, ["key", "class", "component"])
    return blocked.select("key", "node", "component", "n", "class", block.alias("block"))


def size_class(n: Column, percent: int) -> Column:
    """Class of a set's size. If one of two sizes is at least ``percent`` hundredths of the other, their classes differ by 1 at most."""
    return F.floor(F.log(n.cast("double")) / math.log(100 / percent) + 1e-9).cast("int")


def block_pairs(crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """key, items and items_2 of the blocks of a bucket that have to be compared."""
    item = F.struct("node", "component", "shingles", "sketch", "keys")
    blocks = crowded.join(sets.drop("n"), "node").groupBy("key", "class", "block").agg(F.collect_list(item).alias("items"))
    blocks = materialize(blocks, "near-blocks")
    other = blocks.select("key", F.col("class").alias("class_2"), F.col("block").alias("block_2"), F.col("items").alias("items_2"))
    shared = F.col("block").startswith("s/") & F.col("block_2").startswith("s/")
    apart = F.substring_index("block", "/", 1) != F.substring_index("block_2", "/", 1)
    in_class = (F.col("class") == F.col("class_2")) & (F.col("block") <= F.col("block_2"))
    in_next = F.col("class") + 1 == F.col("class_2")
    return blocks.join(other, "key").where((in_class | in_next) & (shared | apart)).select("key", "items", "items_2")


def block_links(paired: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Links (a, b) between components, from pairs of blocks."""
    least = least_estimate(threshold)

    def arrays(key: int, items: list[dict]) -> tuple:
        keys = np.array([np.frombuffer(i["keys"], np.int64) for i in items])
        own = (keys == key).any(1)  # a node of several texts is here for one of them
        items = [i for i, x in zip(items, own) if x]
        sets_ = [np.frombuffer(i["shingles"], np.uint64) for i in items]
        sketches = np.array([np.frombuffer(i["sketch"], np.uint8) for i in items])
        return np.array([i["node"] for i in items]), np.array([i["component"] for i in items]), np.array([len(s) for s in sets_]), sketches, sets_, keys[own]

    def compare(key: int, left: tuple, right: tuple) -> Iterator[tuple[int, int]]:
        """Links across components, of pairs that share no earlier band: those meet in that band's bucket."""
        near: dict[int, int] = {}

        def root(c: int) -> int:
            while near.get(c, c) != c:
                c = near[c]
            return c

        nodes, groups, sizes, sketches, sets_, keys = right
        if not len(left[0]) or not len(nodes):
            return
        band = int((keys[0] == key).argmax())
        for i in range(len(left[0])):
            low, high = np.minimum(sizes, left[2][i]), np.maximum(sizes, left[2][i])
            j = np.flatnonzero((groups != left[1][i]) & (100 * low >= percent * high))
            j = j[(keys[j] == left[5][i]).argmax(1) == band] if len(j) else j
            j = j[(sketches[j] == left[3][i]).mean(1) >= least] if len(j) else j
            for k in j:
                a, b = root(int(left[1][i])), root(int(groups[k]))
                if a != b and similar(left[4][i], sets_[k], percent):
                    near[a] = b
                    yield int(left[0][i]), int(nodes[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for key, one, two in zip(*(batch.column(i) for i in range(3))):
                held.extend(compare(key.as_py(), arrays(key.as_py(), one.as_py()), arrays(key.as_py(), two.as_py())))
            if held:
                yield pa.RecordBatch.from_pydict({"a": pa.array([h[0] for h in held]), "b": pa.array([h[1] for h in held])})

    return map_arrow(paired, run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id and kept of every row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets.
    """
    threshold = percent / 100
    marks = materialize(describe(docs, key, text, threshold, words), "near-marks")
    shown = marks.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    reps = materialize(
        shown.groupBy("digest").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("keys").alias("keys")), "near-nodes"
    )
    named = materialize(shown.select("id", "digest").join(reps.select("digest", "node"), "digest").select("id", "node").distinct(), "near-ids")
    several = named.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("id", "a")
    several = materialize(several, "near-several")
    same_id = named.join(several, "id").where("node <> a").select("a", F.col("node").alias("b")).distinct()

    members = reps.select(F.explode("keys").alias("key"), "node", "n")
    heads = members.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("m")).where("m > 1")
    heads = materialize(heads, "near-heads")
    members = materialize(join_keys(members, heads.select("key"), "key", "left_semi"), "near-buckets")
    pairs = members.join(heads, "key").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    pairs = materialize(pairs, "near-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = materialize(full_sets(docs, materialize(wanted, "near-wanted"), key, text, threshold, words), "near-sets")
    links = materialize(verified(pairs, sets, threshold, percent).unionByName(same_id), "near-links")
    groups = components(links)
    crowded = materialize(crowds(members, heads, groups, percent), "near-blocked")
    if not crowded.isEmpty():
        more = materialize(block_links(block_pairs(crowded, sets), threshold, percent), "near-more")
        if not more.isEmpty():
            groups = components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    smallest = named.join(groups, "node", "left").select("id", F.coalesce("component", "node").alias("component_id"))
    smallest = materialize(smallest.distinct(), "near-components")
    found = marks.select("id", F.col("n").alias("n_shingles")).join(smallest, "id", "left")
    found = found.withColumn("component_id", F.coalesce("component_id", "id"))
    kept = F.col("id").isNull() | (F.col("id") == F.col("component_id"))
    return found.select(F.col("id").alias(key), "n_shingles", "component_id", kept.alias("kept"))


def one_of_each_group(docs: DataFrame, percent: int = 80, words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` but for those whose text is a near-duplicate, over links, of a row that stays: that of the smallest id.

    Rows count one by one: where ids are missing or repeated, all rows are numbered in order of their ids first,
    and the smallest number stays, rows without an id being last.
    """
    repeated = docs.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1))
    name = key
    if not materialize(repeated.select(key), "near-repeated").isEmpty():
        name = fresh_name(docs.columns, "row")
        order = [F.asc_nulls_last(key), F.xxhash64(text)]
        ordered = docs.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
        docs = materialize(ordered.withColumn(name, F.monotonically_increasing_id()), "near-numbered")
    groups = near_duplicates(docs.select(name, text), percent, words, name, text)
    # The documents that go are fewer than those that stay.
    gone = materialize(groups.where(~F.col("kept")).select(name), "near-gone")
    rows = join_keys(docs, gone, name, "left_anti")
    return rows if name == key else rows.drop(name)
