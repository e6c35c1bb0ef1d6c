"""Byte-level BPE: encoding by longest matches and backtracking, and decoding.

A sequence of tokens is what the merges give exactly if every adjacent pair in it is *compatible*:
encoding the two tokens' bytes gives the two tokens back. So a piece is encoded from left to right
with the longest token at each place (found by one pass of an Aho-Corasick automaton over the bytes,
mapped to Latin-1 characters); where it doesn't fit its left neighbour or leads to a place known as a
dead end, the next shorter token is tried, and without one the last token is taken back. Every place
becomes a dead end once at most, which bounds the work by the piece's length.

Text is split by the pattern first, and each match is encoded separately. Nothing is shuffled, and a
task holds one Arrow batch, the vocabulary and a bounded cache of pieces.

Null text is encoded as empty: no ids. Rows are independent, so repeated rows, ties and extra columns
make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from clickloom.llm.common import emit, map_arrow

#: Pieces whose ids a task remembers, none of over 64 characters: some 100 MB. When the cache is full, and when a
#: partition ends, only the pieces that came first stay, which are the frequent ones.
CACHED_PIECES, KEPT_PIECES = 400_000, 50_000
#: Token pairs whose compatibility a worker remembers, some 64 MB, and those of them that stay when these are full.
CACHED_PAIRS, KEPT_PAIRS = 600_000, 200_000


class BytePairEncoding:
    """Encoder and decoder for a table of ranks; a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self._automaton.make_automaton()
        self._length = {rank: len(token) for token, rank in ranks.items()}
        self._shorter: dict[int, int | None] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}
        self._pieces: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if len(self._pieces) > CACHED_PIECES:
            self.forget()
        cache = self._pieces
        pieces = self.pattern.findall(text)
        long = []
        for piece in set(pieces).difference(cache):
            cache[piece] = _packed(self.encode_piece(piece.encode("utf-8", "surrogatepass")))
            if len(piece) > 64:
                long.append(piece)
        ids = b"".join(map(cache.__getitem__, pieces))
        for piece in long:
            del cache[piece]
        return ids

    def forget(self) -> None:
        """Cut the cache of pieces to those that came first."""
        self._pieces = dict(islice(self._pieces.items(), KEPT_PIECES))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, _unpacked(ids)))

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        size = len(piece)
        longest: list[int | None] = [None] * (size + 1)
        for end, (rank, back) in self._automaton.iter(piece.decode("latin-1")):
            longest[end - back] = rank  # ends ascend, so the longest token of a place comes last
        length, known = self._length, self._fits.get
        dead: set[int] = set()
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        while at < size:
            if token is None:
                if last < 0:
                    raise ValueError(f"no tokens for bytes {piece[at:at + 8]!r}")
                dead.add(at)
                token = self.shorter(out.pop())
                at -= length[last]
                last = out[-1] if out else -1
                continue
            end = at + length[token]
            fits = known(last << 32 | token)
            if (self.fits(last, token) if fits is None else fits) and end not in dead:
                out.append(token)
                at, last, token = end, token, longest[end]
            else:
                token = self.shorter(token)
        return out

    def shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix."""
        if token not in self._shorter:
            whole = self.bytes_of[token]
            found = (self.ranks.get(whole[:n]) for n in range(len(whole) - 1, 0, -1))
            self._shorter[token] = next((x for x in found if x is not None), None)
        return self._shorter[token]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; none for single bytes and for tokens no merge makes."""
        if token not in self._halves:
            parts = [bytes([b]) for b in self.bytes_of[token]]
            while len(parts) > 2:
                ranked = [self.ranks.get(x + y, token) for x, y in zip(parts, parts[1:])]
                first = min(ranked)
                if first >= token:
                    break
                i = ranked.index(first)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            known = len(parts) == 2 and all(p in self.ranks for p in parts)
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if known else None
        return self._halves[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges of the two tokens' bytes end in these two tokens; left is -1 at the start."""
        if len(self._fits) > CACHED_PAIRS:
            kept = dict(islice(self._fits.items(), KEPT_PAIRS))
            self._fits.clear()  # the encoder holds on to this very table
            self._fits.update(kept)
        fits = self._made(right) if left < 0 else self._apart(left, right)
        self._fits[left << 32 | right] = fits
        return fits

    def _made(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self.halves(token) is not None

    def _apart(self, a: int, b: int) -> bool:
        """Go back in time from the two tokens: no merge across their border may come before theirs."""
        if not (self._made(a) and self._made(b)):
            return False
        before = None
        while True:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and (before is None or across < before):
                return False
            split_a, split_b = self.halves(a), self.halves(b)
            if split_a is None and split_b is None:
                return True
            if split_b is None or (split_a is not None and a > b):
                before, a = a, split_a[1]  # equal merges go from left to right: the left one came first
            else:
                before, b = b + 1, split_b[0]


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _unpacked(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> BytePairEncoding:
    return BytePairEncoding(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (binary: little-endian unsigned 32-bit) of every row.

    ``path`` names the rank file; it must be there on every executor.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            schema = pa.schema([("key", keys.type), ("ids", pa.binary())])
            rows = ((k.as_py(), codec.encode(t.as_py() or "")) for k, t in zip(keys, texts))
            yield from emit(rows, schema, lambda row: len(row[1]) + 16)
        codec.forget()

    return map_arrow(docs.select(docs[key].alias("key"), docs[text].alias("text")), run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` (binary) of every row."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            keys, packed = batch.column(0), batch.column(1)
            schema = pa.schema([("key", keys.type), ("ids", pa.binary()), ("decoded", pa.binary())])
            rows = ((k.as_py(), i, codec.decode(i)) for k, i in zip(keys, (x.as_py() or b"" for x in packed)))
            yield from emit(rows, schema, lambda row: len(row[1]) + len(row[2]) + 16)

    out = encoded.select(encoded[key].alias("key"), encoded[ids].alias("ids"))
    return map_arrow(out, run, f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)
