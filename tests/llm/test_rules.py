"""Text statistics against a plain version, and the learned decision list."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from samples import PROSE

from clickloom.llm import rules
from clickloom.llm.queries import QUERIES

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if counts[run] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_statistics(docs):
    rnd = random.Random(7)
    texts = ["", None, " \n\t", "a b c d e", "a b c d e a b c d e", "a a a a a a", "a a a a a", "x\n\nx\n x\nx", "é🙂 #*$%&|<>\x0b\x1c y", "w " * 30_000]
    texts += [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(40))) + rnd.choice(["", "\na b\na b\n"]) for _ in range(200)]
    found = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in rules.with_statistics(docs(*enumerate(texts))).collect()}
    assert found == {i: plain(t) for i, t in enumerate(texts)}


def labelled(spark, docs, count=600):
    """Bad texts have many symbols, or capitals; some of each are unlabelled."""
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(count):
        words = [rnd.choice(PROSE) + str(rnd.randrange(99)) * (rnd.random() < 0.1) for _ in range(rnd.randrange(20, 60))]
        kind = i % 4
        if kind == 0:
            words = [w + "###" for w in words]
        elif kind == 1:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind > 1)))
    return docs(*rows), spark.createDataFrame(labels[: count * 3 // 4], "doc_id long, quality int"), labels


def test_list_is_learned_in_order(spark, docs):
    given, labels, truth = labelled(spark, docs)
    statistics = rules.materialize(rules.with_statistics(given.select("doc_id", "text")), "test")
    judged, learned = rules.judge(statistics, labels)
    assert 2 <= len(learned) <= 4
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert sum(kept[i] == bool(good) for i, good in truth) > 0.97 * len(truth)
    assert sorted(r["doc_id"] for r in rules.kept_rows(given, learned).collect()) == [i for i, _ in truth if kept[i]]
    assert rules.kept_rows(given, learned).columns == given.columns


def plain_list(rows, max_rules=8, max_conditions=3, min_precision=0.9, min_cover=5):
    """Sequential covering over (features, bad, held) rows in plain Python."""
    def holds(rule, x):
        return all(x[f] >= v if op == ">=" else x[f] <= v for f, op, v in rule)

    def counts(some):
        bad = sum(b for _, b, _ in some)
        return bad, len(some) - bad

    found = []
    while len(found) < max_rules:
        left = [r for r in rows if not any(holds(rule, r[0]) for rule in found)]
        grown, pruned = [r for r in left if not r[2]], [r for r in left if r[2]]
        rule = ()
        while len(rule) < max_conditions:
            some = [r for r in grown if holds(rule, r[0])]
            bad, good = counts(some)
            if not bad or not good:
                break
            best = (0.0, None)
            for f in rules.FEATURES:
                for v in sorted({x[f] for x, _, _ in some}):
                    for op in (">=", "<="):
                        p, n = counts([r for r in some if holds(((f, op, v),), r[0])])
                        gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good))) if p else 0.0
                        if gain > best[0] + 1e-9:
                            best = gain, (f, op, v)
            if best[1] is None:
                break
            rule += (best[1],)
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            bad, good = counts([r for r in pruned if holds(rule[:k], r[0])])
            worth.append(((bad - good) / (good + bad) if good + bad else -1.0, -k, bad, good))
        _, k, bad, good = max(worth)
        if bad < min_cover or bad < min_precision * (good + bad):
            break
        found.append(rule[:-k])
    return found


def test_list_equals_plain_covering(spark, docs):
    for seed in (1, 2):
        rnd = random.Random(seed)
        rows, marks = [], []
        for i in range(300):
            words = [rnd.choice(PROSE) + rnd.choice(["", "", "#", "!"]) * (i % 3) for _ in range(rnd.randrange(12, 40))]
            if i % 5 == 0:
                words = [w.upper() for w in words]
            rows.append((i, " ".join(words)))
            marks.append((i, int(i % 3 < 2 and i % 5 > 0) if rnd.random() > 0.05 else rnd.randrange(2)))
        labels = spark.createDataFrame(marks, "doc_id long, quality int")
        statistics = rules.materialize(rules.with_statistics(docs(*rows).select("doc_id", "text")), "test")
        good = dict(marks)
        held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
        given = [(r.asDict(), not good[r["doc_id"]], r["held"]) for r in statistics.where(~rules.base_failed()).withColumn("held", held).collect()]
        want = plain_list(given)
        assert rules.learn(statistics, labels) == want and want


def test_without_labels(spark, docs):
    given = docs((1, "a b c d e f g h i j"), (2, "short"), (3, None), (None, "k l m n o p q r s t"), (1, "a b c d e f g h i j"))
    statistics = rules.materialize(rules.with_statistics(given.select("doc_id", "text")), "test")
    for labels in ([], [(1, 1)], [(1, None), (None, 0)], [(2, 0), (2, 1)]):
        judged, learned = rules.judge(statistics, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert learned == []
        assert sorted((str(r["doc_id"]), r["base_failed"], r["kept"]) for r in judged.collect()) == [
            ("1", False, True), ("1", False, True), ("2", True, False), ("3", True, False), ("None", False, True),
        ]
    assert rules.kept_rows(given.where("doc_id > 9"), []).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op10_quality_rules"](spark, sf)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[n] for n in NAMES) == plain(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
