"""Divergence of sources against a plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from clickloom.llm import divergence

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n long, docs string"


def plain(rows, least=3, top=200):
    counts, holding, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = LETTERS.findall(text)
        counts[lang, source].update(found)
        holding[lang].update(set(found))
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in holding[lang].items() if n >= least]
        whole = Counter()
        for s in names:
            whole.update(counts[lang, s])
        total = sum(whole[t] for t in kept)

        def share(count, n):
            return 1 + 1_000_000_000 * (count + 1) // (n + len(kept))

        n = {s: sum(counts[lang, s][t] for t in kept) for s in names}
        for s in names:
            pairs = []
            for other in names - {s}:
                value = 0
                for t in kept:
                    p, q = share(counts[lang, s][t], n[s]), share(counts[lang, other][t], n[other])
                    value += (p - q) * (p - q) // q
                pairs.append((other, value))
            terms = []
            for t in kept:
                if counts[lang, s][t]:
                    p, q = share(counts[lang, s][t], n[s]), share(whole[t], total)
                    if p > q:
                        terms.append((t, (p - q) * (p - q) // q))
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def audited(spark, rows, **options):
    found = divergence.audit(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in found)


def made(seed, size, langs, sources):
    words = ["the", "Of", "ÉTÉ", "ñu", "x", "über", "A", "zz", "q\x00r", "don't", "a1b", "日本", " w"]
    pick = random.Random(seed)
    rows = []
    for i in range(size):
        text = pick.choice([" ", "-", "\n", "_9"]).join(pick.choices(words, range(1, len(words) + 1), k=pick.randrange(40)))
        rows.append((i, pick.choice([text, text, text, None, ""]), pick.choice(langs), pick.choice(sources), i, "x"))
    return rows


@pytest.mark.parametrize("dense, block", [(512, 1 << 20), (2, 50), (0, 7)])
def test_equals_plain_version(spark, monkeypatch, dense, block):
    monkeypatch.setattr(divergence, "_DENSE", dense)
    monkeypatch.setattr(divergence, "_FULL", 2)
    monkeypatch.setattr(divergence, "_BLOCK", block)
    monkeypatch.setattr(divergence, "_HELD", 20)
    rows = made(dense, 120, ["en", "de", None, ""], ["a", "b", "c", None, "ä"])
    assert audited(spark, rows) == plain(rows)


def test_few_terms_ranked(spark):
    rows = made(5, 60, ["en"], ["a", "b"])
    assert audited(spark, rows, terms_ranked=2) == plain(rows, top=2)


def test_language_without_kept_terms(spark):
    rows = [(1, "one two", "en", "a", 0, ""), (2, "three", "en", "b", 0, ""), (3, None, "fr", "a", 0, "")]
    assert audited(spark, rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_group_without_terms(spark):
    rows = [(i, "one two two", "en", "a", 0, "") for i in range(3)] + [(9, "123", "en", "b", 0, ""), (None, None, "en", "c", 0, "")]
    assert audited(spark, rows) == plain(rows)


def test_repeated_rows_and_long_text(spark):
    rows = [(1, "w " * 700_000 + "end", "en", "a", 0, "")] * 3 + [(2, "end w", "en", "b", 0, "")]
    assert audited(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_level_product_is_the_matrix_product(monkeypatch):
    monkeypatch.setattr(divergence, "_FULL", 3)
    random_numbers = np.random.default_rng(1)
    for dense in (0, 3, 512):
        monkeypatch.setattr(divergence, "_DENSE", dense)
        ones = random_numbers.random((300, 12)) < random_numbers.random(12)
        row, column = np.nonzero(ones)
        x, y, n = divergence.level_product(row, column, 12)
        got = np.zeros((12, 12), int)
        np.add.at(got, (x, y), n)
        want = np.triu(ones.T.astype(int) @ ones.astype(int), 1)
        assert (got + got.T == want + want.T).all()
