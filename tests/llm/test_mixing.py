"""Mixing of sources: targets, draws, the splitting tree and its sampling."""

import math
import re
from collections import Counter, defaultdict

import pytest
from clickloom.llm import mixing
from clickloom.llm.queries import QUERIES
from pyspark.sql import functions as F
from samples import PROSE, SF_DIR

SCHEMA = "doc_id long, text string, source string, lang string, chunk string"


def targets(sizes, weights=(5, 2, 1), percent=150, most=2):
    """By source: what the weights give, shared again until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, set(names), percent / 100 * sum(sizes.values())
    while free:
        each = left / sum(weight[s] for s in free)
        full = {s for s in free if each * weight[s] > most * sizes[s]}
        if not full:
            out |= {s: each * weight[s] for s in free}
            break
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        free -= full
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def text_of(i, n):
    return " ".join(PROSE[(i * 7 + j) % len(PROSE)] for j in range(n))


def corpus(spark, rows):
    return spark.createDataFrame([(*r, "en", "x") for r in rows], SCHEMA)


def some_rows():
    rows = [(i, text_of(i, 1 + (i * 37) % 90), ("web", "wiki", "books", "ä", None, "src10", "src2")[i % 7 if i % 3 else 0]) for i in range(600)]
    rows += [(1000, None, "web"), (1001, "", None), (1002, " \t\n", "empty"), (None, text_of(1, 30), "web"), (None, text_of(1, 30), "web"), (1003, text_of(3, 5000), "wiki")]
    return rows


OPTIONS = dict(keep=("doc_id", "source"), block_words=300, shard_words=2000, colours=3)


@pytest.fixture(scope="module")
def mixed(spark):
    return mixing.mix(corpus(spark, some_rows()), **OPTIONS).cache()


def test_targets_and_words_taken(mixed):
    rows = mixed.collect()
    sizes = Counter()
    for _, text, source in some_rows():
        sizes[source] += words(text)
    want = targets(sizes)
    taken, docs = Counter(), defaultdict(list)
    assert len(rows) == len(some_rows())
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert len(r["draws"]) <= 2 and (r["size"] or not r["draws"])
        assert len({d["epoch"] for d in r["draws"]}) == len(r["draws"])
        taken[r["source"]] += r["size"] * len(r["draws"])
        docs[r["source"]].append(r["size"])
    for source, n in want.items():
        # A row that would still fit the gap is only missing if none so small was left in the last block.
        assert n - taken[source] < 300 and taken[source] <= n + 0.5


def test_reruns_agree(spark, mixed):
    turned = corpus(spark, some_rows()[::-1]).repartition(7)
    again = mixing.mix(turned, **OPTIONS)
    columns = ["doc_id", "source", "size", "target", F.to_json("draws").alias("draws")]
    assert sorted(map(str, again.select(*columns).collect())) == sorted(map(str, mixed.select(*columns).collect()))
    other = mixing.mix(turned, **OPTIONS, seed=5)
    assert sorted(map(str, other.select(*columns).collect())) != sorted(map(str, mixed.select(*columns).collect()))


def test_shards_have_equal_numbers_of_blocks(spark, mixed, monkeypatch):
    kept = {}
    plain = mixing.splitting_tree
    monkeypatch.setattr(mixing, "splitting_tree", lambda spark, amounts, shards, seed: kept.setdefault("tree", (amounts, shards, plain(spark, amounts, shards, seed)))[2])
    mixing.mix(corpus(spark, some_rows()), **OPTIONS)
    amounts, shards, tree = kept["tree"]
    by_shard, by_colour = Counter(), Counter()
    for r in tree.collect():
        by_shard[r["shard"]] += r["n"]
        by_colour[r["colour"]] += r["n"]
    assert [by_colour[c] for c in range(len(amounts))] == amounts
    assert shards > 8 and set(by_shard) == set(range(shards)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    used = {d["shard"] for r in mixed.collect() for d in r["draws"]}
    assert used <= set(range(shards)) and len(used) > shards * 0.9


def test_shuffled_shards(mixed):
    rows = mixing.shuffled(mixed).collect()
    assert len(rows) == sum(len(r["draws"]) for r in mixed.collect())
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert {"doc_id", "source", "size", "shard", "place"} == set(mixing.shuffled(mixed).columns)


def test_equal_rows_spread_over_blocks(spark):
    one = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("two words").alias("text"), F.lit("a").alias("source"))
    other = spark.range(2000).select("id", F.lit("one").alias("text"), F.lit("b").alias("source"))
    rows = mixing.mix(one.union(other), block_words=1000, shard_words=5000)
    found = rows.groupBy("size", F.size("draws").alias("n"), "target").count().collect()
    taken = Counter()
    for r in found:
        taken[r["size"]] += r["size"] * r["n"] * r["count"]
    want = targets({"a": 60_000, "b": 2000})
    assert abs(taken[2] - want["a"]) <= 2 and taken[1] == want["b"]
    spread = rows.where("size = 2").select(F.explode("draws.shard").alias("s")).groupBy("s").count().collect()
    assert len(spread) == 19 and max(r["count"] for r in spread) < 2 * min(r["count"] for r in spread)


@pytest.mark.parametrize("rows, taken", [([], 0), ([(1, None, "a"), (2, "", None)], 0), ([(1, "one two", "a")], 2), ([(1, "w " * 100_000, None), (1, "x", "a")], None)])
def test_small_corpora(spark, rows, taken):
    got = mixing.mix(corpus(spark, rows)).collect()
    assert len(got) == len(rows)
    if taken is not None:
        assert sum(r["size"] * len(r["draws"]) for r in got) == taken


def test_kept_names_must_not_clash(spark):
    with pytest.raises(ValueError):
        mixing.mix(corpus(spark, []).withColumn("Size", F.lit(1)), keep=("doc_id", "Size"))


@pytest.mark.parametrize("whole, own, drawn", [(1, 1, 1), (10, 4, 5), (10, 0, 5), (10, 10, 3), (50, 7, 43), (400, 100, 200), (1_000_000, 3, 500_000)])
def test_hypergeometric(spark, whole, own, drawn):
    steps = 20_000
    uniform = f"((id + 0.5D) / {steps})"
    found = spark.range(steps).select(F.expr(mixing.hypergeometric(str(whole), str(own), str(drawn), uniform)).alias("x")).groupBy("x").count().collect()
    for r in found:
        x = r["x"]
        chance = math.comb(drawn, x) * math.comb(whole - drawn, own - x) / math.comb(whole, own)
        assert r["count"] / steps == pytest.approx(chance, abs=3 / steps)


def test_hypergeometric_of_many(spark):
    whole, own, drawn = 10**9, 3 * 10**8, 5 * 10**8
    sql = mixing.hypergeometric(str(whole), str(own), str(drawn), "((id + 0.5D) / 64)")
    found = [r["x"] for r in spark.range(64).select(F.expr(sql).alias("x")).collect()]
    deviation = math.sqrt(drawn * 0.3 * 0.7 * 0.5)
    assert abs(sum(found) / 64 - 1.5e8) < deviation / 8
    assert math.sqrt(sum((x - 1.5e8) ** 2 for x in found) / 64) == pytest.approx(deviation, rel=0.1)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000])
def test_permutation(spark, size):
    got = [r["y"] for r in spark.range(size).select(mixing.permuted("id", str(size), 3).alias("y")).collect()]
    assert sorted(got) == list(range(size))
    assert size < 10 or got != sorted(got)


def test_query(spark):
    rows = QUERIES["op11_splitting_tree"](spark, SF_DIR).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    sizes = Counter()
    for d in docs.values():
        sizes[d["source"]] += words(d["text"])
    want, taken = targets(sizes), Counter()
    assert len(rows) == len(docs)
    for r in rows:
        d = docs[r["doc_id"]]
        assert r["size"] == words(d["text"]) and r["source_size"] == sizes[d["source"]]
        assert r["target"] == pytest.approx(want[d["source"]]) and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[d["source"]] += r["taken"]
    for source, n in want.items():
        assert 0.95 * n - 20 <= taken[source] <= n + 0.5
