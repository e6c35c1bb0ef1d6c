"""Word-wise encoding against the tokenizers library, bin completion, and packing."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from clickloom.llm import packing
from clickloom.llm.queries import QUERIES
from pyspark.sql import functions as F
from samples import SF_DIR

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def test_words_against_library(library):
    rnd = random.Random(2)
    encoder = packing.WordEncoder(PATH)
    assert encoder._wordwise
    texts = ["".join(rnd.choice("ab.,'sST \n\x00\x85éÉΣ1￼̀!#") for _ in range(rnd.randrange(40))) for _ in range(2000)]
    texts += ["", "Hello WORLD!!! it's 12 o'clock***", "<|endoftext|>", "ΣΑΣ Σ ﬁ İ", "a" * 5000]
    found = encoder.encode(texts)
    for text, packed in zip(texts, found):
        assert np.frombuffer(packed, "<u4").tolist() == ids_of(library, text)[:-1]


def used(patterns):
    out = Counter()
    for n, items in patterns:
        for length in items:
            out[length] += n
    return out


def number(patterns):
    return sum(n for n, _ in patterns)


def fewest(lengths, size):
    """By trying all: only for a handful."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= lengths[i] and room not in rooms[:j]:
                place(i + 1, [*rooms[:j], room - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, size - lengths[i]])

    place(0, [])
    return best[0]


def test_bin_completion_finds_the_fewest():
    rnd = random.Random(3)
    for _ in range(300):
        size = rnd.choice([10, 30, 100])
        lengths = sorted((rnd.randrange(max(1, size // 6), size + 1) for _ in range(rnd.randrange(1, 10))), reverse=True)
        counts = Counter(lengths)
        found = packing.complete_bins(counts, size)
        assert used(found) == counts and all(sum(items) <= size for _, items in found)
        bins, first = number(found), number(packing.best_fit(counts, size))
        best = fewest(lengths, size)
        assert packing.lower_bound(counts, size) <= best <= bins <= first
        assert bins == best


def test_bin_completion_improves_on_best_fit():
    for times in (1, 1000):
        counts = {n: c * times for n, c in Counter([44, 24, 24, 22, 21, 17, 8, 8, 6, 6]).items()}
        found = packing.complete_bins(counts, 60)
        assert used(found) == counts and number(found) == 3 * times < number(packing.best_fit(counts, 60))


def test_many_of_a_length():
    counts = {2048: 10**9, 1024: 10**9 + 1, 700: 3 * 10**8, 648: 3 * 10**8, 3: 5}
    found = packing.complete_bins(counts, 2048)
    assert used(found) == counts
    bins, lower = sum(n for n, _ in found), packing.lower_bound(counts, 2048)
    assert bins <= lower * 1.01
    assert packing.complete_bins({}, 2048) == [] and packing.lower_bound({}, 2048) == 0


def test_layout_gives_every_rank_its_own_place():
    counts = Counter(random.Random(4).randrange(1, 200) for _ in range(3000))
    layout = packing.Layout(packing.complete_bins(counts, 200))
    filled = Counter()
    for length, n in counts.items():
        sequence, offset = layout.place(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            for i in range(o, o + length):
                filled[s, i] += 1
    assert max(filled.values()) == 1 and len(filled) == sum(l * n for l, n in counts.items())


def check(library, rows, packed, size):
    by_sequence = {}
    whole = {}
    for r in packed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        whole.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    want = {}
    for key, text in rows:
        ids = ids_of(library, text)
        for n, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at : at + size], "<u4")
            want.setdefault(key, []).append((n, at, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in want.items()}
    return len(by_sequence)


def test_packing_documents(docs, library):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(rnd.randrange(90)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "null id"), rows[4], rows[4], (502, "word " * 20_000), (503, "x " * 63)]
    cut = packing.pieces(docs(*rows), PATH, 64)
    packed = packing.pack(packing.numbered(cut), 64).collect()
    bins = check(library, rows, packed, 64)
    assert bins <= -(-sum(len(ids_of(library, t)) for _, t in rows) // 64) + 1


def test_sequences_hold_the_ids(docs, library):
    rows = [(1, "one two three"), (2, "four"), (3, "five six " * 20)]
    cut = packing.pieces(docs(*rows), PATH, 16, with_ids=True)
    found = packing.sequences(packing.pack(packing.numbered(cut), 16)).collect()
    assert sum(len(r["ids"]) for r in found) == 4 * sum(len(ids_of(library, t)) for _, t in rows)
    assert max(len(r["ids"]) for r in found) <= 64


def test_equal_pieces_share_out(spark):
    cut = packing.numbered(spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(1).cast("long").alias("length"), F.lit(7).cast("long").alias("ids_crc32")))
    order = ["doc_id", "piece", "start", "ids_crc32", "_row"]
    sizes = cut.groupBy(F.pmod(F.xxhash64(*order), F.lit(10)).alias("chunk")).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 21_000
    ranks = packing.with_ranks(cut, order).agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()
    assert tuple(ranks) == (0, 199_999, 200_000)
    packed = packing.pack(cut).groupBy("sequence_id").agg(F.count("*").alias("n"), F.countDistinct("offset").alias("places")).collect()
    assert len(packed) == -(-200_000 // 2048) and all(r["n"] == r["places"] for r in packed)


def test_query(spark):
    """The registered query against the library on whole texts, and the lower bound."""
    rows = QUERIES["op8_bin_completion"](spark, SF_DIR).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    bins = check(Tokenizer.from_file(PATH), docs, rows, 2048)
    assert bins == -(-sum(r["length"] for r in rows) // 2048)


def test_empty_table(docs):
    assert packing.pack_documents(docs((1, "x")).where("doc_id > 1"), PATH).collect() == []
