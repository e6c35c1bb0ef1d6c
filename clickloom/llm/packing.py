"""Packing token sequences: documents into as few sequences of a fixed size as can be found.

Documents become token ids with an end id; only those longer than a sequence are cut. What matters for
packing is how many pieces there are of each length, a table of at most ``size`` rows however large the
corpus. Bin completion runs on that table: the largest length left is completed with undominated fillings
(one that could swap an item for a larger one left over, or two for one, is dominated), in order of waste;
a filling is used for as many sequences as its lengths allow; branches whose waste rules out an improvement
are pruned, and the best-fit solution is the incumbent from the start. The search ends at the lower bound
or after a fixed number of nodes, so its result is the same on every run.

The solution says which ranks of a length go to which sequences. Ranks come from counts by length and
hash chunk and a numbering within each chunk, so a length with very many pieces is spread over tasks.

Null text counts as empty: its document is the end id alone. Rows are independent: repeated rows and null
ids are packed like others. An empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import emit, map_arrow
from clickloom.sources.tables import materialize

#: Bytes of the words whose ids a task remembers, and what a word takes besides its letters and ids. When the cache is full,
#: and when a partition ends, only the words that came first stay, which are the frequent ones.
CACHED_BYTES, _WORD_BYTES, KEPT_WORDS = 72 << 20, 180, 150_000
#: Bytes of text whose words are looked up together.
_GROUP_BYTES = 1 << 20

Filling = tuple[int, ...]
Pattern = tuple[int, Filling]  # number of sequences, lengths in each from the front


#: ASCII marks that end words; a run of them after a letter is a token sequence of its own.
_MARKS = b".,;:!?#$%&*|"


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder:
    """Ids of a lower-casing, byte-level tokenizer that never joins across white space, word by word.

    Equal to the tokenizer on whole texts, but each word is encoded once while it stays in the cache.
    Words share the ids of their stems, without the marks at the end. Stems of Latin letters alone go to
    the tokenizer's merges directly; all others go through the whole tokenizer. A tokenizer of another
    kind, told by a probe, encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._merges = Tokenizer(self._tokenizer.model)
        self._merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._letters = _byte_letters()
        self._cache: dict[bytes, bytes] = {}
        self._cached = 0
        probe = ["The thing, it's über\n\tfine!! a|b élan. 12 été***", "x", " .", "ab\x00 c"]
        self._wordwise = True
        self._wordwise = self.encode(probe) == [self._ids(p) for p in probe]
        self._cache.clear()
        self._cached = 0

    def forget(self) -> None:
        """Cut the cache to the words that came first."""
        self._cache = dict(islice(self._cache.items(), KEPT_WORDS))
        self._cached = sum(map(len, self._cache)) * 3 + len(self._cache) * _WORD_BYTES

    def _ids(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self._wordwise:
            return [self._ids(t) for t in texts]
        if self._cached > CACHED_BYTES:
            self.forget()
        cache = self._cache
        words = [t.encode("utf-8").lower().split() for t in texts]  # A-Z; at ASCII white space
        self._learn(set().union(*words).difference(cache))
        return [b"".join(map(cache.__getitem__, w)) for w in words]

    def _learn(self, words: set[bytes]) -> None:
        cache = self._cache
        parted: list[tuple[bytes, bytes, bytes]] = []
        plain: set[bytes] = set()
        other: set[bytes] = set()
        for word in words:
            stem = word.rstrip(_MARKS)
            text = stem.decode("utf-8")
            if text.isalpha() and max(text) < "\u0100":
                plain.add(stem)
                if len(stem) < len(word):
                    parted.append((word, stem, word[len(stem) :]))
                    other.add(word[len(stem) :])
            else:
                other.add(word)
        letters = self._letters
        new = list(plain.difference(cache))
        self._learn_all(new, [w.decode("utf-8").lower().encode("utf-8").decode("latin-1").translate(letters) for w in new], self._merges, letters[0])
        new = list(other.difference(cache))
        self._learn_all(new, [w.decode("utf-8") for w in new], self._tokenizer, "\x00")
        for word, stem, marks in parted:
            cache[word] = cache[stem] + cache[marks]
        # Words and their stems with their ids, of which one stands for every other letter.
        self._cached += 4 * sum(map(len, words)) + (len(words) + len(plain)) * _WORD_BYTES

    def _learn_all(self, words: list[bytes], texts: list[str], tokenizer, border: str) -> None:
        """Encode several words at once, with a border word between any two."""
        mark = tokenizer.encode(border, add_special_tokens=False).ids
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            ids = _packed(tokenizer.encode_batch_fast([f" {border} ".join(texts[at : at + 4096])], add_special_tokens=False)[0].ids)
            cuts = np.flatnonzero(ids == mark[0])
            if len(mark) != 1 or len(cuts) != len(some) - 1:  # a word holds the border's character
                self._cache.update((w, self._ids(w.decode("utf-8"))) for w in some)
                continue
            packed = ids.tobytes()
            starts = [0, *((cuts + 1) * 4).tolist()]
            ends = [*(cuts * 4).tolist(), len(packed)]
            self._cache.update(zip(some, map(packed.__getitem__, map(slice, starts, ends))))


def _packed(ids: list[int]) -> np.ndarray:
    return np.array(ids, "<u4")


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces(docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """key, piece, start, length and ids_crc32 of every piece, and its ids (binary) if asked for."""
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(key: object, ids: bytes) -> Iterator[tuple]:
        for number, at in enumerate(range(0, len(ids), 4 * size)):
            part = ids[at : at + 4 * size]
            yield (key, number, at // 4, len(part) // 4, zlib.crc32(part)) + ((part,) if with_ids else ())

    def rows(keys: pa.Array, texts: pa.Array) -> Iterator[tuple]:
        encoder = _encoder(path)
        held: list[tuple[object, str]] = []
        room = _GROUP_BYTES
        for k, t in zip(keys, texts):
            held.append((k.as_py(), t.as_py() or ""))
            room -= len(held[-1][1])
            if room < 0:
                yield from (row for (k, _), ids in zip(held, encoder.encode([t for _, t in held])) for row in cut(k, ids + end))
                held, room = [], _GROUP_BYTES
        if held:
            yield from (row for (k, _), ids in zip(held, encoder.encode([t for _, t in held])) for row in cut(k, ids + end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [("key", batch.column(0).type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
            schema = pa.schema(fields + [("ids", pa.binary())] * with_ids)
            yield from emit(rows(batch.column(0), batch.column(1)), schema, lambda row: 64 + 4 * row[3] * with_ids)
        _encoder(path).forget()

    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_arrow(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run, schema).withColumnRenamed("key", key)


def lower_bound(counts: dict[int, int], size: int) -> int:
    """No packing has fewer sequences: total length, and for each k that items over size - k share with none of at least k."""
    number = np.zeros(size + 2, dtype=object)
    for length, n in counts.items():
        number[length] = n
    total = number * np.arange(size + 2)
    n_up, t_up = np.cumsum(number), np.cumsum(total)
    half = size // 2
    best = -(-int(t_up[-1]) // size)
    for k in range(1, half + 1):
        alone = n_up[-1] - n_up[size - k]
        pairs = n_up[size - k] - n_up[half]
        free = pairs * size - (t_up[size - k] - t_up[half])
        small = t_up[half] - t_up[k - 1]
        best = max(best, int(alone + pairs + max(0, -(-(small - free) // size))))
    return best


def best_fit(counts: dict[int, int], size: int) -> list[Pattern]:
    """Best fit, longest first; sequences with the same content are kept as one pattern."""
    open_: dict[int, list[Pattern]] = {}
    rooms: list[int] = []  # in ascending order

    def put(room: int, pattern: Pattern) -> None:
        if room not in open_:
            open_[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        open_[room].append(pattern)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_right(rooms, length - 1)
            if at < len(rooms):
                room = rooms[at]
                number, items = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, number, items = size, left, ()
            each = room // length  # a sequence stays the best fit until full
            whole = min(number, left // each)
            if whole:
                put(room - each * length, (whole, items + (length,) * each))
            left -= whole * each
            rest = min(left, each - 1) if whole < number else 0
            if rest:
                put(room - rest * length, (1, items + (length,) * rest))
                left -= rest
            if items and number > whole + (1 if rest else 0):
                put(room, (number - whole - (1 if rest else 0), items))
    return [pattern for group in open_.values() for pattern in group]


def fillings(counts: dict[int, int], lengths: list[int], room: int, limit: int) -> list[Filling]:
    """Undominated fillings of ``room`` from what is left, at most ``limit`` tried, by waste."""
    found: dict[Filling, int] = {}
    steps = limit

    def fill(room: int, most: int, items: Filling) -> bool:
        """False once the limit is reached or a filling is perfect."""
        nonlocal steps
        if counts.get(room, 0) > items.count(room) and room <= most:
            found[items + (room,)] = 0  # nothing dominates an exact fit
            return False
        at = bisect_right(lengths, min(room, most)) - 1
        fitted = False
        while at >= 0:
            length = lengths[at]
            if counts[length] > items.count(length):
                fitted = True
                steps -= 1
                if steps < 0 or not fill(room - length, length, items + (length,)):
                    return False
                if lengths[at] * 2 <= room and len(items) > 6:
                    break  # many small ones: the greedy filling stands for them
            at -= 1
        if not fitted:
            found[items] = room
        return True

    fill(room, room, ())
    if not found:
        found[()] = room
    kept = [(waste, f) for f, waste in found.items() if not _dominated(f, waste, counts, lengths)]
    return [f for _, f in sorted(kept or [(waste, f) for f, waste in found.items()])]


def _dominated(items: Filling, waste: int, counts: dict[int, int], lengths: list[int]) -> bool:
    """Whether an item, or two, could be swapped for a longer one that is left over and fits."""
    if not waste:
        return False
    singles = set(items)
    sums = {(a + b, a, b) for i, a in enumerate(items) for b in items[i + 1 :]}
    for total, *parts in [(a, a) for a in singles] + sorted(sums):
        at = bisect_right(lengths, total + waste) - 1
        while at >= 0 and lengths[at] > total - (len(parts) > 1):
            if counts[lengths[at]] > items.count(lengths[at]):
                return True
            at -= 1
    return False


def complete_bins(counts: dict[int, int], size: int, nodes: int = 20_000, tries: int = 400) -> list[Pattern]:
    """Sequences for ``counts`` pieces of each length, as few as ``nodes`` steps of bin completion find."""
    left = {length: n for length, n in counts.items() if n}
    best = best_fit(left, size)
    bins = sum(n for n, _ in best)
    lower = lower_bound(left, size)
    total = sum(length * n for length, n in left.items())
    lengths = sorted(left)
    chosen: list[Pattern] = []
    waste = used = 0

    def options() -> Iterator[Filling]:
        top = lengths[-1]
        left[top] -= 1
        found = fillings(left, lengths, size - top, tries)
        left[top] += 1
        return iter([(top, *f) for f in found])

    def change(pattern: Pattern, sign: int) -> None:
        nonlocal waste, used
        number, items = pattern
        for length in items:
            before = left[length]
            left[length] = before + sign * number
            if not left[length]:
                lengths.remove(length)
            elif not before:
                lengths.insert(bisect_right(lengths, length), length)
        used -= sign * number
        waste -= sign * number * (size - sum(items))

    stack = [options()] if lengths and bins > lower else []
    while stack and nodes > 0:
        items = next(stack[-1], None)
        if items is None:
            stack.pop()
            if chosen:
                change(chosen.pop(), 1)
            continue
        number = min(left[length] // items.count(length) for length in set(items))
        # An improvement saves a sequence, so it can waste no more than this.
        if waste + number * (size - sum(items)) > (bins - 1) * size - total:
            continue
        nodes -= 1
        change((number, items), -1)
        if lengths:
            chosen.append((number, items))
            stack.append(options())
            continue
        best, bins = [*chosen, (number, items)], used
        change((number, items), 1)
        if bins <= lower:
            break
    return best


class Layout:
    """Which sequence and offset the piece of a rank within its length gets."""

    def __init__(self, patterns: list[Pattern]):
        taken: dict[int, int] = {}
        rows = []
        sequence = 0
        for number, items in patterns:
            offset = 0
            for length in dict.fromkeys(items):
                each = items.count(length)
                lo = taken.get(length, 0)
                rows.append((length, lo, each, offset, sequence))
                taken[length] = lo + each * number
                offset += each * length
            sequence += number
        rows.sort()
        self.length, self.lo, self.each, self.offset, self.sequence = np.array(rows, np.int64).reshape(-1, 5).T

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset for zero-based ranks."""
        first = np.searchsorted(self.length, length, side="left")
        after = np.searchsorted(self.length, length, side="right")
        while (wide := after - first > 1).any():  # halve the ranges of equal length down to the rank's
            middle = (first + after) // 2
            right = wide & (self.lo[np.minimum(middle, len(self.lo) - 1)] <= rank)
            first = np.where(right, middle, first)
            after = np.where(wide & ~right, middle, after)
        instance, slot = np.divmod(rank - self.lo[first], self.each[first])
        return self.sequence[first] + instance, self.offset[first] + slot * length


def with_ranks(cut: DataFrame, order: list[str], chunk_rows: int = 20_000) -> DataFrame:
    """``cut`` with ``rank``: a number from 0 within each length, without a gap.

    The last column of ``order`` is different in every row, so equal rows share out over the chunks like others.
    ``cut`` is read twice: pass a written table.
    """
    chunks = max(8, -(-cut.count() // chunk_rows))
    chunked = cut.withColumn("chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    counted = chunked.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "chunk").orderBy(*order)
    ranked = chunked.withColumn("place", F.row_number().over(within)).join(base, ["length", "chunk"])
    return ranked.withColumn("rank", F.col("base") + F.col("place") - 1).drop("chunk", "place", "base")


def numbered(cut: DataFrame) -> DataFrame:
    """The pieces, written with a number in ``_row`` that no other has."""
    return materialize(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")


def pack(cut: DataFrame, size: int = 2048, nodes: int = 20_000, key: str = "doc_id") -> DataFrame:
    """The ``numbered`` pieces with ``sequence_id`` and ``offset``."""
    counts = {row["length"]: row["n"] for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    layout = Layout(complete_bins(counts, size, nodes))
    ranked = with_ranks(cut, [key, "piece", "start", "ids_crc32", "_row"])
    kept = [f for f in cut.schema if f.name != "_row"]
    ranked = ranked.select(*[f.name for f in kept], "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            sequence, offset = layout.place(length, batch.column(batch.num_columns - 1).to_numpy())
            columns = [*batch.columns[:-1], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return map_arrow(ranked, run, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.array_join(F.transform(parts, lambda p: p["ids"].cast("string")), "").cast("binary")
    return packed.groupBy("sequence_id").agg(ids.alias("ids"))


def pack_documents(docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id and offset of every piece of the documents."""
    return pack(numbered(pieces(docs, path, size, end_id, key, text)), size, key=key)
