"""Shingle sets, sketches and near-duplicate groups against brute force."""

import random

import numpy as np
import pytest
from samples import PROSE

from clickloom.llm import minhash
from clickloom.llm.shingles import band_keys, shingle_set, similarity_sketch

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in SPACE:
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


def plain_set(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent):
    sets = {}
    for key, text in rows:
        if key is not None:
            sets.setdefault(key, []).append(plain_set(text))
    group = {k: k for k in sets}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((root(a), root(b)))
                group[hi] = lo
    out = []
    for key, text in rows:
        c = None if key is None else root(key)
        out.append((key, len(plain_set(text)), c, key is None or key == c))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def varied(rnd, n, vocabulary=2000):
    return [f"{rnd.choice(PROSE)}{rnd.randrange(vocabulary)}" for _ in range(n)]


def changed(rnd, words, count):
    words = list(words)
    for _ in range(count):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return words


def test_shingle_sets():
    for text in ("", " \n", "one", "A b C d", "a b c d e", "a b c d e f a b c d e", "x\x1cy z q", "É é Z z"):
        assert len(shingle_set(text)) == len(plain_set(text))
    assert (shingle_set("A  b\tC d e F") == shingle_set("a b c d e f")).all()
    assert not set(shingle_set("a b c d")) & set(shingle_set("a b c d e"))


@pytest.mark.parametrize("n", [1, 3, 40, 5000])
def test_sketch_fills_every_coordinate(n):
    sketch = similarity_sketch(np.arange(1, n + 1, dtype=np.uint64), 150)
    assert sketch.max() < np.iinfo(np.uint64).max
    assert len(band_keys(sketch, 6)) == 25


def test_sketch_is_what_all_rounds_give():
    """Stopping early and doing rounds together changes nothing."""
    from clickloom.llm import shingles as s

    elements, size = np.array([5, 77, 10**12, 3, 9], np.uint64), 16
    bins = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    for i in range(2 * size):
        hashed = s.mix(elements + np.uint64(i + 1) * s._STEP)
        for h in hashed:
            place = int(h >> np.uint64(48)) * size >> 16 if i < size else i - size
            bins[place] = min(bins[place], np.uint64(i << 48 | int(h) & (1 << 48) - 1))
    assert (similarity_sketch(elements, size) == bins).all()


def test_sketches_estimate_similarity():
    rnd = np.random.default_rng(1)
    for size in (30, 2000):
        errors = []
        for _ in range(60):
            both = rnd.integers(1, 2**63, size, dtype=np.uint64)
            a = np.concatenate([both, rnd.integers(1, 2**63, size // 4, dtype=np.uint64)])
            b = np.concatenate([both, rnd.integers(1, 2**63, size // 4, dtype=np.uint64)])
            errors.append((similarity_sketch(a, 150) == similarity_sketch(b, 150)).mean() - size / (size + 2 * (size // 4)))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_groups_against_brute_force(docs):
    rnd = random.Random(8)
    rows = []
    for _ in range(12):
        base = varied(rnd, rnd.choice([8, 30, 120]))
        rows += [(rnd.randrange(10**6), " ".join(changed(rnd, base, rnd.randrange(5)))) for _ in range(12)]
    rows += [(10**6 + i, "a b c d e f g") for i in range(60)]  # a third are copies
    rows += [(2 * 10**6 + i, t) for i, t in enumerate(["", None, " \n\t", "one", "One", "two words", "one\x1c"])]
    rows += [(None, "a b c d e f g"), (None, None), rows[0], rows[0], (rows[1][0], rows[20][1])]
    for percent in (80, 85):
        got = minhash.near_duplicates(docs(*rows), percent=percent)
        assert found(got) == brute(rows, percent)


def test_all_texts_of_an_id_are_linked(docs):
    one, two, three = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [(1, one), (2, two), (3, one), (3, two), (3, three), (4, three), (5, "v w x y z")]
    got = minhash.near_duplicates(docs(*rows), percent=85)
    assert got.count() == len(rows) and found(got) == brute(rows, 85)


def test_crowd_that_stars_do_not_join(docs, monkeypatch):
    """A chain: each text is close to the next one only, and blocks hold few documents."""
    monkeypatch.setattr(minhash, "BLOCK", 600)
    monkeypatch.setattr(minhash, "LEAST", 100)
    rnd = random.Random(9)
    words = varied(rnd, 150)
    rows = []
    for i in range(60):
        rows.append((rnd.randrange(10**6), " ".join(words)))
        words[rnd.randrange(150)] = f"step{i}"
        words[rnd.randrange(150)] = f"more{i}"
    assert found(minhash.near_duplicates(docs(*rows), percent=85)) == brute(rows, 85)


def test_shared_passage_makes_few_pairs(spark, docs, monkeypatch):
    """Texts of many lengths hold the same passage: buckets are wide, but sizes keep most members apart."""
    monkeypatch.setattr(minhash, "BLOCK", 4000)
    monkeypatch.setattr(minhash, "LEAST", 50)
    rnd = random.Random(10)
    passage = varied(rnd, 120)
    rows = [(i, " ".join(passage + varied(rnd, 10 + i))) for i in range(0, 400, 2)]
    rows += [(1000 + i, " ".join(changed(rnd, rows[i][1].split(), 2))) for i in range(0, 40, 2)]
    made, wide, plain = [], [], minhash.block_pairs

    def counted(crowded, sets):
        wide.extend(r["count"] for r in crowded.groupBy("key").count().collect())
        made.append(plain(crowded, sets))
        return made[-1]

    monkeypatch.setattr(minhash, "block_pairs", counted)
    assert found(minhash.near_duplicates(docs(*rows), percent=85)) == brute(rows, 85)
    pairs = sum(len(r["items"]) * len(r["items_2"]) for df in made for r in df.select("items", "items_2").collect())
    assert max(wide) > 20 and pairs < sum(n * n for n in wide) / 2, (pairs, wide)


def test_size_classes(spark):
    for percent in (80, 85):
        sizes = spark.range(1, 400).select("id", minhash.size_class(minhash.F.col("id"), percent).alias("c")).collect()
        for a in sizes:
            assert all(b["c"] - a["c"] <= 1 for b in sizes if b["id"] >= a["id"] and 100 * a["id"] >= percent * b["id"])


def test_empty_and_wholly_different(docs):
    given = docs((1, "a b c d e"), (2, "f g h i j"), (3, "word " * 50_000))
    assert found(minhash.near_duplicates(given)) == brute([(1, "a b c d e"), (2, "f g h i j"), (3, "word " * 50_000)], 80)
    assert minhash.near_duplicates(given.where("doc_id > 9")).collect() == []


def test_components_of_long_chains_and_stars(spark):
    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(80)] + [(500, 500)]
    pairs += [(rnd.randrange(1000, 1050), rnd.randrange(1000, 1050)) for _ in range(60)]
    group = {x: x for p in pairs for x in p}

    def root(k):
        return k if group[k] == k else root(group[k])

    for a, b in pairs:
        lo, hi = sorted((root(a), root(b)))
        group[hi] = lo
    got = {r["node"]: r["component"] for r in minhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    joined = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: root(x) for x in joined}


def test_banding():
    for threshold in (0.5, 0.8, 0.85, 0.95):
        bands, rows = minhash.banding(threshold)
        assert (1 - threshold**rows) ** bands <= 1.01e-5


def test_sketches_rule_out_less_than_bands():
    from math import comb

    for percent in (80, 85):
        threshold = percent / 100
        bands, rows = minhash.banding(threshold)
        n, least = bands * rows, minhash.least_estimate(threshold)
        lost = sum(comb(n, k) * percent**k * (100 - percent) ** (n - k) for k in range(n + 1) if k / n < least) / 100**n
        assert lost <= 1e-7
