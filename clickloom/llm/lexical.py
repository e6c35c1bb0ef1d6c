"""Ranked lexical search: the best documents for every item, over an inverted index in shards.

Index. Tasks cut their documents into shards of some ``shard_bytes`` of text (a longer document is a shard of
its own). A shard is one row: its terms, and for each term the places of the documents that hold it, in order,
with the number of occurrences. Shards are written once; nothing is shuffled.

Search, by a hybrid of term-at-a-time and document-at-a-time. Items go to all shards in blocks of a bounded
number of (item, term) entries. In a shard an item's terms fall into short and long lists. The short ones are
taken term at a time: their contributions are added up into one accumulator a document. These accumulators then
are one more list, with bounds like any other. The shard is gone through in windows of documents, those with
the highest bound (largest accumulator plus the largest contribution of each long list there) first, until
no bound reaches the item's threshold, the k-th best score so far. In a window each document whose own bound
reaches the threshold is scored, long lists being skipped through to the documents still in question, which
become fewer with each list. A task carries the best k of an item from shard to shard.

Scores are whole numbers: the sum over the item's terms, with repeats, of w * ((1e9 * tf) div (1000 * tf + 12 * m)),
w = floor(1000 * ln((2 N + 2) / (2 df + 1))), m = 75 + ((25 * n * N) div L); N documents with terms, L their terms,
df documents that hold the term, n terms of the document, tf occurrences in it. Bounds are sums of the same numbers,
so the results are exact.

Ids of documents are whole numbers. Null texts have no terms: such documents count for nothing and are not found,
such items find nothing. Rows without an id count and can be found, after others of an equal score. Repeated rows
are documents, and items, of their own. Equal scores go by ascending id. An empty table of either kind gives an
empty result; extra columns don't matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import emit, map_arrow
from clickloom.llm.terms import LETTERS_DIGITS, terms
from clickloom.sources.tables import fresh_path

#: Documents of a shard at most, so that places take 16 bits.
_SHARD_DOCS = 1 << 16
#: Row groups of the index, in bytes: a reader holds one.
_ROW_GROUP = 16 << 20
#: Documents of a window; a list is short if it holds at most one in SHORT of the shard's documents.
_WINDOW, _SHORT = 512, 16
#: (item, term) entries of a block of items.
_BLOCK_ENTRIES = 1 << 20
#: Stands for a missing id in sorting.
_NO_ID = np.iinfo(np.int64).max

_INDEX = "docs int, n_with long, n_terms long, ids array<long>, lengths binary, terms binary, sizes binary, places binary, counts binary"
_INDEX_SCHEMA = pa.schema(
    [("docs", pa.int32()), ("n_with", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64()))]
    + [(name, pa.binary()) for name in ("lengths", "terms", "sizes", "places", "counts")]
)


class _Numbers(dict):
    """Numbers terms in the order in which they are first asked for."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _shard(ids: list[int | None], numbers: _Numbers, codes: list[np.ndarray]) -> tuple:
    """The row of a shard; ``codes`` has the term numbers of each document."""
    lengths = np.array([len(c) for c in codes], np.int64)
    whole = np.concatenate(codes) if codes else np.empty(0, np.int64)
    place = np.repeat(np.arange(len(codes)), lengths)
    pairs, counts = np.unique(whole * _SHARD_DOCS + place, return_counts=True)
    sizes = np.bincount(pairs // _SHARD_DOCS, minlength=len(numbers))
    packed = (lengths.astype("<u8"), sizes.astype("<u4"), (pairs % _SHARD_DOCS).astype("<u2"), counts.astype("<u4"))
    lengths_, sizes_, places_, counts_ = (x.tobytes() for x in packed)
    return len(ids), int((lengths > 0).sum()), int(lengths.sum()), ids, lengths_, b" ".join(numbers), sizes_, places_, counts_


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = 4 << 20) -> DataFrame:
    """One row a shard of the documents that have terms."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ids: list[int | None] = []
        codes: list[np.ndarray] = []
        numbers, size = _Numbers(), 0
        for batch in batches:
            for k, t in zip(*batch.columns):
                own = [np.fromiter(map(numbers.__getitem__, part), np.int64, len(part)) for part in terms(t.as_py(), LETTERS_DIGITS)]
                found = np.concatenate(own)
                if not len(found):
                    continue
                ids.append(k.as_py())
                codes.append(found)
                size += 6 * len(found)
                if size >= shard_bytes or len(ids) == _SHARD_DOCS:
                    yield _shard(ids, numbers, codes)
                    ids, codes, numbers, size = [], [], _Numbers(), 0
        if ids:
            yield _shard(ids, numbers, codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(shards(batches), _INDEX_SCHEMA, lambda row: sum(map(len, row[3:])))

    return map_arrow(docs.select(F.col(key).cast("long"), F.col(text).cast("string")), run, _INDEX)


class Items:
    """A block of items: ids, and their terms as numbers of a common vocabulary with their repeats."""

    def __init__(self, kind: pa.DataType):
        self.kind = kind
        self.ids: list[object] = []
        self.terms = _Numbers()
        self.entries: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, key: object, text: str | None) -> None:
        held: Counter[int] = Counter()
        for part in terms(text, LETTERS_DIGITS):
            held.update(map(self.terms.__getitem__, part))
        self.ids.append(key)
        self.entries.append((np.fromiter(held.keys(), np.int64, len(held)), np.fromiter(held.values(), np.int64, len(held))))
        self.size += len(held) + 1


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[Items]:
    """The items, a block at a time; the driver holds no more than one block and one partition of items."""
    kind = items.select(key).limit(0).toArrow().schema.field(0).type
    block = Items(kind)
    for row in items.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).toLocalIterator():
        block.add(row["key"], row["text"])
        if block.size >= _BLOCK_ENTRIES:
            yield block
            block = Items(kind)
    if block.ids:
        yield block


def holding(index: DataFrame, wanted: dict[bytes, int]) -> np.ndarray:
    """Number of documents that hold each wanted term; the driver gets a row a term."""
    known = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(known.value), np.int64)
        for batch in batches:
            for words, sizes in zip(*batch.columns):
                place = np.fromiter((known.value.get(w, -1) for w in words.as_py().split(b" ")), np.int64)
                hit = place >= 0
                found[place[hit]] += np.frombuffer(sizes.as_buffer(), "<u4")[hit]
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held), "df": pa.array(found[held])})

    out = np.zeros(len(wanted), np.int64)
    for row in map_arrow(index.select("terms", "sizes"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    known.unpersist()
    return out


class Shard:
    """A shard's lists for the terms of a block of items, with all contributions but for the weights."""

    def __init__(self, row: dict[str, pa.Scalar], wanted: dict[bytes, int], docs: int, length: int):
        n = np.frombuffer(row["lengths"].as_buffer(), "<u8").astype(np.int64)
        if 25 * int(n.max()) * docs < 1 << 63:
            m = 75 + (25 * n * docs) // length
        else:
            m = np.array([75 + 25 * int(x) * docs // length for x in n], np.int64)
        self.ids = np.array([_NO_ID if x is None else x for x in row["ids"].as_py()], np.int64)
        self.docs = len(n)
        sizes = np.frombuffer(row["sizes"].as_buffer(), "<u4").astype(np.int64)
        place = np.fromiter((wanted.get(w, -1) for w in row["terms"].as_py().split(b" ")), np.int64, len(sizes))
        hit = place >= 0
        inside = np.repeat(hit, sizes)
        self.places = np.frombuffer(row["places"].as_buffer(), "<u2")[inside].astype(np.int64)
        tf = np.frombuffer(row["counts"].as_buffer(), "<u4")[inside].astype(np.int64)
        self.part = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.places])
        ends = np.cumsum(sizes[hit])
        self.start, self.end = np.full(len(wanted), 0), np.full(len(wanted), 0)
        self.start[place[hit]], self.end[place[hit]] = ends - sizes[hit], ends
        self.windows = np.arange(0, self.docs, _WINDOW)
        self._tops: dict[int, np.ndarray] = {}

    def tops(self, term: int) -> np.ndarray:
        """The largest contribution of a list in each window."""
        if term not in self._tops:
            s = slice(self.start[term], self.end[term])
            top = np.zeros(len(self.windows), np.int64)
            np.maximum.at(top, self.places[s] // _WINDOW, self.part[s])
            self._tops[term] = top
        return self._tops[term]

    def search(self, term: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Offer ``best`` every document that may be among the best k."""
        sizes = self.end[term] - self.start[term]
        term, weight, sizes = term[sizes > 0], weight[sizes > 0], sizes[sizes > 0]
        short = sizes * _SHORT <= self.docs
        sums = np.zeros(self.docs, np.int64)
        for t, w in zip(term[short], weight[short]):
            s = slice(self.start[t], self.end[t])
            sums[self.places[s]] += w * self.part[s]  # a document is in a list once
        long, long_weight = term[~short], weight[~short]
        tops = np.array([w * self.tops(t) for t, w in zip(long, long_weight)]).reshape(len(long), len(self.windows))
        order = np.argsort(-tops.max(1, initial=0), kind="stable")
        long, long_weight, tops = long[order], long_weight[order], tops[order]
        rest = np.vstack([np.cumsum(tops[::-1], axis=0)[::-1], np.zeros((1, len(self.windows)), np.int64)])
        bound = np.maximum.reduceat(sums, self.windows) + rest[0]
        for window in np.argsort(-bound, kind="stable"):
            if bound[window] < best.threshold:
                break
            first = window * _WINDOW
            score = sums[first : first + _WINDOW]
            doc = np.flatnonzero(score + rest[0, window] >= best.threshold)
            score = score[doc]
            for i in range(len(long)):
                places = self.places[self.start[long[i]] : self.end[long[i]]]
                at = np.searchsorted(places, first + doc)
                hit = at < len(places)
                hit[hit] = places[at[hit]] == first + doc[hit]
                score[hit] += long_weight[i] * self.part[self.start[long[i]] + at[hit]]
                stays = score + rest[i + 1, window] >= best.threshold
                doc, score = doc[stays], score[stays]
                if not len(doc):
                    break
            if len(doc):
                best.offer(score, self.ids[first + doc])


class Best:
    """The k best of an item so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k = k
        self.threshold = 1
        self.score, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.ids = score[order], ids[order]
        if len(order) == self.k:
            self.threshold = int(self.score[-1])


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    shard_bytes: int = 4 << 20,
) -> DataFrame:
    """The item's key, rank, the document's key, score: the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    item_kind = items.schema[item_key].dataType.simpleString()
    path, out = fresh_path(spark, "lexical-index"), fresh_path(spark, "lexical-found")
    # One row holds a shard: small row groups bound what a reader holds.
    build_index(docs, key, text, shard_bytes).write.option("parquet.block.size", _ROW_GROUP).parquet(path)
    index = spark.read.schema(_INDEX).parquet(path)
    sums = index.agg(F.sum("n_with").alias("docs"), F.sum("n_terms").alias("length")).first()
    n, length = sums["docs"] or 0, sums["length"] or 0
    schema = f"query long, item {item_kind}, id long, score long"
    query = 0
    for block in item_blocks(items, item_key, item_text) if n else ():
        df = holding(index, block.terms)
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        entries = []
        for term, repeats in block.entries:
            used = (df[term] > 0) & (weight[term] > 0)
            entries.append((term[used], weight[term[used]] * repeats[used]))
        known = spark.sparkContext.broadcast((dict(block.terms), block.ids, block.kind, entries, query))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted, ids, kind, entries, first = known.value
            best = [Best(k) for _ in entries]
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = Shard({name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}, wanted, n, length)
                    for (term, own), b in zip(entries, best):
                        shard.search(term, own, b)
            number = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
            if len(number):
                found = np.concatenate([b.ids for b in best])
                columns = [
                    pa.array(number + first),
                    pa.array([ids[x] for x in number], kind),
                    pa.array(found, mask=found == _NO_ID),
                    pa.array(np.concatenate([b.score for b in best])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "item", "id", "score"])

        read = index.select("ids", "lengths", "terms", "sizes", "places", "counts")
        map_arrow(read, run, schema).write.mode("append").parquet(out)
        known.unpersist()
        query += len(block.ids)
    found = spark.read.schema(schema).parquet(out) if query else spark.createDataFrame([], schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score")
