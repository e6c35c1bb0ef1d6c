"""Quality rules: text statistics, base thresholds and a learned decision list, as Spark columns.

The list is learned by sequential covering. A rule is a conjunction of thresholds on whole-number
statistics; it is grown on two thirds of the labelled rows, condition by condition, by the largest
information gain, then cut back to the prefix that does best on the other third. Rules that aren't
precise enough there end the search; else the rows a rule covers are set aside and the next is grown.
The result is one ordered conditional expression.

Every step is one aggregate over the labelled rows: counts by statistic, value and label. Statistics
are clipped to 0..200, so the driver sees a bounded table whatever the corpus' size, and all labelled
rows count.

Null text has no words and fails the base rules, as does an empty one. Labels that are null are left
out; of several labels of a document the lowest counts. Without labelled rows of both kinds the list
is empty and keeps what the base rules keep. Repeated rows are judged alike, each row on its own.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import SPACE, WORD, join_keys, let
from clickloom.sources.tables import materialize

#: Characters that count as symbols. Fixed value.
SYMBOLS = "#*$%&|<>"
#: Words of a window. Fixed value.
WINDOW = 5
#: Statistics the learned rules may use; whole numbers from 0 to TOP.
FEATURES = (
    "pct_symbols",
    "pct_upper",
    "pct_letters",
    "pct_distinct_words",
    "pct_repeat_words",
    "pct_dup_lines",
    "marks_per_100_words",
    "chars_per_10_words",
)
TOP = 200

Condition = tuple[str, str, int]
Rule = tuple[Condition, ...]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the FEATURES.

    Columns of those names are replaced.
    """
    body = F.coalesce(docs[text], F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    out = docs.withColumns(
        {
            "_words": F.array_remove(F.split(body, f"[{SPACE}]+"), ""),
            "_lines": lines,
            "word_chars": F.length(F.regexp_replace(body, f"[{SPACE}]+", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "_letters": F.length(F.regexp_replace(body, r"[^\p{L}]+", "")),
            "_upper": F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")),
            "_marks": F.length(body) - F.length(F.translate(body, "!?", "")),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda word: F.xxhash64(word)),
        }
    )
    out = out.withColumn("_windows", _windows(F.col("_hashes")))
    out = out.withColumn("n_repeat_words", _repeated(F.col("_windows")).cast("long"))
    features = {
        "pct_symbols": _part(F.col("n_symbols"), F.col("word_chars")),
        "pct_upper": _part(F.col("_upper"), F.col("_letters")),
        "pct_letters": _part(F.col("_letters"), F.col("word_chars")),
        "pct_distinct_words": _part(F.size(F.array_distinct("_hashes")), F.col("n_words")),
        "pct_repeat_words": _part(F.col("n_repeat_words"), F.col("n_words")),
        "pct_dup_lines": _part(F.col("n_dup_lines"), F.size("_lines")),
        "marks_per_100_words": _part(F.col("_marks"), F.col("n_words")),
        "chars_per_10_words": _part(F.col("word_chars"), F.col("n_words"), 10),
    }
    out = out.withColumns(features)
    return out.drop("_words", "_lines", "_hashes", "_windows", "_letters", "_upper", "_marks")


def _part(share: Column, whole: Column, scale: int = 100) -> Column:
    """Whole number of ``scale`` parts, 0 to TOP; 0 of nothing."""
    part = F.when(whole > 0, F.floor(share * scale / whole)).otherwise(0)
    return F.least(part, F.lit(TOP)).cast("int")


def _windows(hashes: Column) -> Column:
    """A hash for each run of WINDOW words."""
    last = F.size(hashes) - WINDOW

    def at(array: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(array, i + k) for k in range(WINDOW)]))

    return F.when(last >= 0, let(hashes, at)).otherwise(F.array().cast("array<bigint>"))


def _repeated(windows: Column) -> Column:
    """Words within windows that occur more than once."""

    def covered(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, i: F.get(ordered, i - 1)["h"].eqNullSafe(x["h"]) | F.get(ordered, i + 1)["h"].eqNullSafe(x["h"]),
        )
        places = F.array_sort(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
        return F.aggregate(
            places,
            start,
            lambda acc, i: F.struct(
                (acc["words"] + i + WINDOW - F.greatest(i, acc["end"])).alias("words"), (i + WINDOW).alias("end")
            ),
            lambda acc: acc["words"],
        )

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(ordered, covered)).otherwise(0)


def base_failed() -> Column:
    """Too short, or over a fifth of the words in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def conditions(rule: Rule) -> Column:
    return reduce(and_, (F.col(name) >= value if op == ">=" else F.col(name) <= value for name, op, value in rule))


def verdict(rules: list[Rule]) -> Column:
    """Keep or reject: the first rule that holds rejects, no rule keeps."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(conditions(rule), F.lit(False)).otherwise(out)
    return out


def learn(
    statistics: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "quality",
    max_rules: int = 8,
    max_conditions: int = 3,
    min_precision: float = 0.9,
    min_cover: int = 5,
) -> list[Rule]:
    """The rules that reject rows with label 0, from rows that pass the base rules.

    ``statistics`` is read once per step: pass a written table.
    """
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("_label"))
    rows = (
        statistics.where(~base_failed())
        .join(marks, key)
        .select(*FEATURES, (F.col("_label") == 0).alias("bad"), (F.pmod(F.xxhash64(key), F.lit(3)) == 0).alias("held"))
        .groupBy(*FEATURES, "bad", "held")
        .count()
        .withColumnRenamed("count", "n")
    )
    rows = materialize(rows, "rule-statistics")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows.where(verdict(rules))
        rule = _grow(left.where(~F.col("held")), max_conditions)
        rule, good, bad = _prune(left.where(F.col("held")), rule)
        if not rule or bad < min_cover or bad < min_precision * (good + bad):
            break
        rules.append(rule)
    return rules


def _grow(rows: DataFrame, max_conditions: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_conditions:
        counts = _counts(rows.where(conditions(rule)) if rule else rows)
        bad = sum(n for values in counts[:1] for (_, is_bad), n in values.items() if is_bad)
        good = sum(n for values in counts[:1] for (_, is_bad), n in values.items() if not is_bad)
        if not bad or not good:
            break
        gain, condition = _best(counts, bad, good)
        if gain <= 0:
            break
        rule += (condition,)
    return rule


def _counts(rows: DataFrame) -> list[dict[tuple[int, bool], int]]:
    """For each feature the number of rows by value and label: one job, at most 2 * TOP rows a feature."""
    long = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(name).alias("v")) for i, name in enumerate(FEATURES)]))
    found = rows.select("bad", "n", long.alias("x")).groupBy("x.f", "x.v", "bad").agg(F.sum("n").alias("n"))
    out: list[dict[tuple[int, bool], int]] = [defaultdict(int) for _ in FEATURES]
    for row in found.collect():
        out[row["f"]][row["v"], row["bad"]] = row["n"]
    return out


def _best(counts: list[dict[tuple[int, bool], int]], bad: int, good: int) -> tuple[float, Condition]:
    """The threshold of the largest gain; ties go to the earlier feature, then the lower value."""
    base = math.log2(bad / (bad + good))
    best: tuple[float, Condition] = (0.0, ("", "", 0))
    for name, values in zip(FEATURES, counts):
        below_bad = below_good = 0
        for value in sorted({v for v, _ in values}):
            options = [(">=", bad - below_bad, good - below_good)]
            below_bad += values.get((value, True), 0)
            below_good += values.get((value, False), 0)
            options.append(("<=", below_bad, below_good))
            for op, p, n in options:
                gain = p * (math.log2(p / (p + n)) - base) if p else 0.0
                if gain > best[0] + 1e-9:
                    best = gain, (name, op, value)
    return best


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of the best (bad - good) / (bad + good) on held rows, the shorter of equals; its counts."""
    if not rule:
        return (), 0, 0
    sums = []
    for k in range(1, len(rule) + 1):
        for is_bad in (False, True):
            sums.append(F.sum(F.when(conditions(rule[:k]) & (F.col("bad") == is_bad), F.col("n"))))
    found = [n or 0 for n in rows.agg(*sums).first()]
    worth = [(bad - good) / (good + bad) if good + bad else -1.0 for good, bad in zip(found[::2], found[1::2])]
    k = max(range(len(rule)), key=lambda i: (worth[i], -i))
    return rule[: k + 1], found[2 * k], found[2 * k + 1]


def judge(statistics: DataFrame, labels: DataFrame, key: str = "doc_id") -> tuple[DataFrame, list[Rule]]:
    """``statistics`` with base_failed and kept, by rules learned from it; and the rules."""
    rules = learn(statistics, labels, key)
    return statistics.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & verdict(rules)}), rules


def kept_rows(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and ``rules``, with their own columns alone."""
    judged = with_statistics(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), "_text")
    # A generated column holds the filter above the statistics; pushed below them it would compute each anew.
    return judged.select("_row", F.explode(F.array(~base_failed() & verdict(rules))).alias("_kept")).where("_kept").select("_row.*")


def screen(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the list learned from the labelled ones among them, with their own columns alone.

    Only labelled rows are gone through for learning.
    """
    known = labels.where(F.col(key).isNotNull()).select(key).distinct()
    marked = join_keys(docs.select(key, text), materialize(known, "rule-labelled"), key, "left_semi")
    learned = learn(materialize(with_statistics(marked, text).drop(text), "rule-statistics-of"), labels, key)
    return kept_rows(docs, learned, text)
