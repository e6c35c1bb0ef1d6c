"""The additive model: interactions, lookup scoring, held-out accuracy, odd input."""

import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import gam
from clickloom.llm.queries import QUERIES

LABELS = "doc_id long, quality int"


def test_lookup_tables_and_interactions():
    rnd = np.random.default_rng(1)
    x = rnd.random((4000, 4))
    steps = (x[:, 0] > 0.6).astype(float)
    crossed = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    for y in (steps, crossed):
        model = gam.AdditiveModel(rounds=60).fit(x[:3000], y[:3000])
        assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.93
    assert (1, 2) in model.pairs
    one = model.score(x[:1])[0]
    logit = model.start
    for i, (edges, table) in enumerate(zip(model.edges, model.tables)):
        logit += table[np.searchsorted(edges, x[0, i], side="right")]
    for (i, j), table in zip(model.pairs, model.pair_tables):
        logit += table[np.searchsorted(model.coarse[i], x[0, i], side="right"), np.searchsorted(model.coarse[j], x[0, j], side="right")]
    assert one == pytest.approx(1 / (1 + np.exp(-logit)))


def kind(c):
    if c in "\t\n\v\f\r":
        return "space"
    if c in "#*%&@\\_/":
        return "symbol"
    own = unicodedata.category(c)
    if own in ("Lu", "Lt"):
        return "upper"
    if own in ("Ll", "Lo", "Lm", "Mn", "Mc"):
        return "lower"
    if own in ("Zs", "Zl", "Zp"):
        return "space"
    return {"N": "digit", "P": "mark", "S": "symbol"}.get(own[0], "other")


def slow_features(text):
    """The features character by character, as FEATURES names them."""
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
    kinds = [kind(c) for c in text]
    counts = Counter(kinds)
    chars, n = max(len(text), 1), max(len(words), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    ending = sum(1 for a, b in zip(kinds, kinds[1:]) if b == "space" and a in ("mark", "symbol"))
    pieces, piece = [], []
    for k in [*kinds, "space"]:
        if k == "space":
            if piece:
                pieces.append(piece)
            piece = []
        else:
            piece.append(k)
    bare = sum(1 for p in pieces if "upper" not in p and "lower" not in p)
    same = sum(1 for a, b in zip(words, words[1:]) if a == b)
    top = Counter(words).most_common(1)
    return [
        math.log(1 + len(words)),
        (chars - counts["space"]) / n,
        counts["upper"] / max(counts["upper"] + counts["lower"], 1),
        *[counts[k] / chars for k in ("digit", "mark", "symbol", "space", "other")],
        len(set(words)) / n,
        (top[0][1] if top else 0) / n,
        same / n,
        len(words) / max(len(lines), 1),
        len(set(lines)) / max(len(lines), 1),
        ending / n,
        bare / n,
    ]


def test_features_against_slow_version(spark):
    rnd = random.Random(4)
    texts = ["", " ", "\n \n", "A", "a a a", "x, y! #z 12 3.4 _ é Ünï 漢字 🙂", "tab\tend.\r\nline\n\nline\n", "\u00a0nb \u2028 z", "ⅷ ² ½"]
    texts += ["".join(rnd.choice("aB \n.,#9é漢🙂\t-\u00a0\x00") for _ in range(rnd.randrange(1, 120))) for _ in range(200)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect() if r["text"]]
    for text in texts:
        assert gam.features(text) == pytest.approx(slow_features(text)), text[:80]


def test_features_of_odd_texts():
    for text in ("", " ", "\n", "a", "🙂\ud800", "x" * 100_000, "\x00"):
        found = gam.features(text)
        assert len(found) == len(gam.FEATURES) and np.isfinite(found).all()


def test_few_or_one_sided_labels(spark, docs):
    given = docs((1, "a b"), (2, None), (3, ""), (None, "x"), (1, "a b"))
    for labels, low, high in (([], 0.5, 0.5), ([(9, 1)], 0.5, 0.5), ([(1, 1), (2, 1)], 0.5, 1.0), ([(1, 0), (1, 1), (2, None), (None, 1)], 0.0, 0.5)):
        model = gam.train(given, spark.createDataFrame(labels, LABELS))
        scores = gam.score(given, model, ["doc_id", "score"], name="own").collect()
        assert len(scores) == 5 and all(low <= r["own"] <= high and r["score"] == "x" for r in scores)
    assert gam.score(given.where("doc_id > 9"), gam.AdditiveModel(), ["doc_id"]).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in QUERIES["op9_additive_model"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(r["quality"], found[r["doc_id"]]) for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(r["held_out"] for _, r in held) and len(held) > 500
    assert sum(q == r["predicted"] for q, r in held) / len(held) > 0.98
    good = [r["score"] for q, r in held if q == 1]
    bad = [r["score"] for q, r in held if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.99
