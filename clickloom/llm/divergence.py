"""How far the sources of a language are apart in their words, priced exactly from joint count tables.

A document's terms are its runs of letters. Each language keeps the terms that at least ``least_docs`` of its
documents hold. A group is a (language, source); N is the sum of its counts over the V kept terms, and a term
that occurs ``count`` times has the share p = 1 + floor(SCALE * (count + 1) / (N + V)). Two shares diverge by
f = floor((p - q) * (p - q) / q).

A share depends on the count alone, so the divergence of two groups follows from their joint table: how many
kept terms have count level a in the one and b in the other. All joint tables come from one product: every
kept term is a row of a 0/1 matrix with a column for each (group, level above 0), and the matrix' transpose
times the matrix counts the terms two columns share. Tasks take the rows in blocks; columns with many terms of
the block are multiplied as dense tiles, whose sums stay below 2^24 and so are exact, the others row by row;
Spark adds the blocks up. Level 0 follows from the margins. With f(a, b) the price of a pair of levels,

    sum of f over all terms = V f(0,0) + sum_a n_g(a) (f(a,0) - f(0,0)) + sum_b n_h(b) (f(0,b) - f(0,0))
                              + sum_ab J(a,b) (f(a,b) - f(a,0) - f(0,b) + f(0,0)).

Null text, language and source count as empty. A text without terms still makes its group occur. Equal values
rank by item in byte order. Repeated rows count as documents of their own, ids are not looked at. A language
that keeps no terms has pairs of value 0 and no terms. An empty table gives an empty result; extra columns
don't matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import emit, join_keys, map_arrow
from clickloom.llm.terms import LETTERS, terms
from clickloom.sources.tables import materialize

SCALE = 1_000_000_000
#: Counts a task holds before it hands them on.
_HELD = 400_000
#: Entries of a block of the matrix; columns of its dense part, and the terms a column needs for it; rows of a tile.
_BLOCK, _DENSE, _FULL, _TILE = 1 << 20, 512, 32, 8192
#: Bytes of a row of groups, for the measured join.
_GROUP_BYTES = 256


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it), as far as tasks sum them up."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[tuple]:
        for group, (number, holding) in held.items():
            for term, n in number.items():
                yield *group, term.decode("utf-8", "replace"), n, holding[term]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for l, s, t in zip(*batch.columns):
                group = l.as_py() or "", s.as_py() or ""
                if group not in held:
                    held[group] = Counter(), Counter()
                    size += 1
                number, holding = held[group]
                before = len(number)
                own: set[bytes] = set()
                for part in terms(t.as_py(), LETTERS):
                    number.update(part)
                    own.update(part)
                holding.update(own)
                size += len(number) - before
                if size > _HELD:
                    yield from emit(rows(held), schema, lambda row: 64)
                    held, size = {}, 0
        yield from emit(rows(held), schema, lambda row: 64)

    found = docs.select(F.col(lang).cast("string"), F.col(source).cast("string"), F.col(text).cast("string"))
    return map_arrow(found, run, "lang string, source string, term string, n long, docs long")


def level_product(row: np.ndarray, column: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns x < y and the number of rows both have a 1 in, where that isn't 0: the transpose times the matrix.

    The matrix is given by its ones, sorted by row; a row has a column at most once.
    """
    weight = np.bincount(column, minlength=columns)
    dense = np.argsort(-weight, kind="stable")[:_DENSE]
    dense = np.sort(dense[weight[dense] >= _FULL])
    place = np.full(columns, -1)
    place[dense] = np.arange(len(dense))
    found = []
    if len(dense):
        total = np.zeros((len(dense), len(dense)))
        inside = place[column] >= 0
        r, c = row[inside], place[column[inside]]
        for start in range(0, int(row[-1]) + 1, _TILE):
            a, b = np.searchsorted(r, (start, start + _TILE))
            tile = np.zeros((_TILE, len(dense)), np.float32)
            tile[r[a:b] - start, c[a:b]] = 1
            total += tile.T @ tile
        x, y = np.nonzero(np.triu(total, 1))
        found.append((dense[x], dense[y], total[x, y].astype(np.int64)))
    thin = np.flatnonzero(place[column] < 0)
    first, after = np.searchsorted(row, row[thin]), np.searchsorted(row, row[thin], side="right")
    for part in np.array_split(np.arange(len(thin)), max(1, int((after - first).sum()) // _BLOCK)):
        width = after[part] - first[part]
        one = np.repeat(column[thin[part]], width)
        other = column[np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first[part], width)]
        # Of two thin columns each row gives both orders: take one.
        once = (place[other] >= 0) | (one < other)
        codes, number = np.unique(np.minimum(one, other)[once] * columns + np.maximum(one, other)[once], return_counts=True)
        found.append((codes // columns, codes % columns, number))
    return tuple(np.concatenate(x) for x in zip(*found))


def joint_tables(vectors: DataFrame) -> DataFrame:
    """lang, source, a, other, b, n: number of terms with level a in ``source`` and b in ``other``, for levels above 0, each pair once."""

    def product(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        counts = table.column("counts").combine_chunks()
        row = np.repeat(np.arange(len(counts)), np.diff(counts.offsets.to_numpy()))
        flat = counts.flatten()
        if not len(flat):
            return
        source = flat.field("source").dictionary_encode()
        lang = table.column("lang").combine_chunks().dictionary_encode()
        level, names = flat.field("n").to_numpy(), source.dictionary
        levels, at = np.unique(level, return_inverse=True)
        code = (lang.indices.to_numpy()[row].astype(np.int64) * len(names) + source.indices.to_numpy()) * len(levels) + at
        kinds, column = np.unique(code, return_inverse=True)
        x, y, n = level_product(row, column, len(kinds))
        group, group_2 = kinds[x] // len(levels), kinds[y] // len(levels)
        out = [
            lang.dictionary.take(pa.array(group // len(names))),
            names.take(pa.array(group % len(names))),
            pa.array(levels[kinds[x] % len(levels)]),
            names.take(pa.array(group_2 % len(names))),
            pa.array(levels[kinds[y] % len(levels)]),
            pa.array(n),
        ]
        whole = pa.RecordBatch.from_arrays(out, names=["lang", "source", "a", "other", "b", "n"])
        for start in range(0, whole.num_rows, 1 << 16):
            yield whole.slice(start, 1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(b.column(1).flatten()) for b in held) >= _BLOCK:
                yield from product(held)
                held = []
        if held:
            yield from product(held)

    tables = map_arrow(vectors.select("lang", "counts"), run, "lang string, source string, a long, other string, b long, n long")
    swapped = F.col("source") > F.col("other")  # blocks number their columns differently

    def ordered(one: str, two: str) -> Column:
        return F.when(swapped, F.col(two)).otherwise(F.col(one))

    tables = tables.select("lang", *[ordered(x, y).alias(x) for x, y in (("source", "other"), ("a", "b"), ("other", "source"), ("b", "a"))], "n")
    return tables.groupBy("lang", "source", "a", "other", "b").agg(F.sum("n").alias("n"))


def _share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + 1) / total), in whole numbers of any size."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(20,0)) + 1)) div cast({total} as decimal(20,0))")


def _price(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def pair_values(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the language) and value.

    ``groups``: lang, source, total (N + V) and kept (V), written.
    """
    tables = materialize(joint_tables(vectors), "divergence-joint")
    levels = vectors.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source", "c.n").agg(F.count("*").alias("n_terms"))
    levels = materialize(levels.withColumnRenamed("n", "a"), "divergence-levels")
    one = groups.where("kept > 0").select("lang", "source", F.col("total").alias("t"), "kept")
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("u"))
    pairs = one.join(other, "lang").where("source <> item").withColumns({"p0": _share("0", "t"), "q0": _share("0", "u")})
    pairs = materialize(pairs.withColumn("f00", _price("p0", "q0")), "divergence-pairs")
    wide = 3 * _GROUP_BYTES

    def summed(rows: DataFrame, value: Column) -> DataFrame:
        return rows.groupBy("lang", "source", "item").agg(F.sum(value).alias("value"))

    def times(number: str, price: Column) -> Column:
        return F.col(number).cast("decimal(18,0)") * price.cast("decimal(19,0)")

    base = pairs.select("lang", "source", "item", (F.col("kept").cast("decimal(18,0)") * F.col("f00").cast("decimal(19,0)")).alias("value"))
    margin = join_keys(levels, pairs, ["lang", "source"], "inner", wide).withColumn("p", _share("a", "t"))
    margin = summed(margin, times("n_terms", _price("p", "q0") - F.col("f00")))
    renamed = levels.withColumnsRenamed({"source": "item", "a": "b"})
    margin_2 = join_keys(renamed, pairs, ["lang", "item"], "inner", wide).withColumn("q", _share("b", "u"))
    margin_2 = summed(margin_2, times("n_terms", _price("p0", "q") - F.col("f00")))
    both = tables.withColumnRenamed("other", "item").unionByName(
        tables.select("lang", F.col("other").alias("source"), F.col("b").alias("a"), F.col("source").alias("item"), F.col("a").alias("b"), "n")
    )
    joint = join_keys(both, pairs, ["lang", "source", "item"], "inner", wide).withColumns({"p": _share("a", "t"), "q": _share("b", "u")})
    joint = summed(joint, times("n", _price("p", "q") - _price("p", "q0") - _price("p0", "q") + F.col("f00")))
    parts = base.unionByName(margin).unionByName(margin_2).unionByName(joint)
    values = parts.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    without = groups.where("kept = 0").select("lang", "source")
    without = without.join(other.select("lang", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    return values.unionByName(without)


def audit(docs: DataFrame, least_docs: int = 3, terms_ranked: int = 200, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: divergence from each other source (``pair``), and the terms a group has more often than its language (``term``)."""
    # One shuffle by term serves the sums of a group and the list of a term's groups.
    counts = term_counts(docs, text, lang, source).repartition("lang", "term")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    vectors = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("whole"), F.collect_list(F.struct("source", "n")).alias("counts"))
    vectors = materialize(vectors.where(F.col("docs") >= least_docs).drop("docs"), "divergence-vectors")

    langs = vectors.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("whole").alias("lang_n"))
    sums = vectors.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("own_n"))
    names = [F.coalesce(docs[x].cast("string"), F.lit("")).alias(y) for x, y in ((lang, "lang"), (source, "source"))]
    groups = docs.select(*names).distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["own_n", "kept", "lang_n"])
    groups = groups.select("lang", "source", "kept", (F.col("own_n") + F.col("kept")).alias("total"), (F.col("lang_n") + F.col("kept")).alias("lang_total"))
    groups = materialize(groups, "divergence-groups")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    used = vectors.select("lang", F.col("term").alias("item"), "whole", F.explode("counts").alias("c")).select("lang", "c.source", "item", "whole", "c.n")
    shares = join_keys(used, groups, ["lang", "source"], "inner", _GROUP_BYTES).withColumns({"p": _share("n", "total"), "q": _share("whole", "lang_total")})
    over = shares.where("p > q").select("lang", "source", "item", _price("p", "q").alias("value"))
    best = ranked(over, "term").where(F.col("rank") <= terms_ranked)
    return ranked(pair_values(vectors, groups), "pair").unionByName(best)
