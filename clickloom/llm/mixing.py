"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets. The mix has ``percent`` hundredths of all words. Sources, in order of their names, have the weights of
``weights`` in turn and share these words; no target exceeds ``most`` times the source's own words, and what is
over is shared again among the others, until none is above.

Blocks. A document's rows are dealt by a hash into blocks of some ``block_words`` words of their source. A source
takes all its blocks as many whole times as its target allows, and the first blocks of a further pass up to the
target. The block in which the target falls is taken in part: rows by size class, largest first, as many of each
class as still fit. So a source's words differ from its target by less than the smallest row left out there, and
no row is taken more than ``most`` times, if ``most`` is a whole number.

Shards. All draws of blocks go to shards of equal numbers of draws. How many draws of each source a shard gets is a
sample without replacement: the range of shards is halved again and again, and each half gets a
multivariate-hypergeometric part of the quotas, source by source, by inversion from the mode. Drawing is not
changed by putting sources together, so sources share ``colours`` quotas and a node holds no more numbers than that.
A keyed permutation of the draws of a colour then deals disjoint runs of them to the shards, in the tree's
numbers, and rows are shuffled within their shard. Everything is a function of the rows and the seed.

Null text has no words, the null source comes last. Rows without words have a target but are not drawn. Rows that
are equal in all kept columns are told apart by a running number, so that they spread over blocks. Null and
repeated ids don't matter. Without rows the result is empty, without words nothing is drawn. Columns that are not
kept may have any name; kept ones may not be named like the columns added here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.common import SPACE, each_copy, join_keys, shuffle_partitions
from clickloom.sources.tables import materialize

#: Blocks that are summed up in one task.
_GROUP = 4096
#: Levels of the tree before its nodes are spread over tasks.
_ALONE = 6
#: Bytes of a row in a join with measured tables.
_ROW_BYTES = 96
_ADDED = ("source_size", "size", "target", "draws", "number", "block", "order", "copies", "copy", "chunk", "rounds", "extra", "shard", "place")


def counted_rows(docs: DataFrame, keep: Sequence[str], text: str, source: str) -> DataFrame:
    """source, the kept columns, size (words) and copies of every distinct row."""
    words = F.size(F.array_remove(F.split(F.coalesce(docs[text], F.lit("")), f"[{SPACE}]+"), "")).cast("long")
    rows = docs.select(docs[source].alias("_source"), *[docs[c] for c in keep], words.alias("size"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))


def numbered_sources(rows: DataFrame) -> DataFrame:
    """source, source_size and number: the place in the order of names, null last."""
    sums = rows.groupBy("_source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    # Order by parts of the range, so that no task sees all sources.
    ordered = sums.repartitionByRange(shuffle_partitions(rows.sparkSession), F.asc_nulls_last("_source"))
    ordered = materialize(ordered.withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    parts = ordered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("part").orderBy(F.asc_nulls_last("_source"))
    placed = ordered.withColumn("at", F.row_number().over(within)).join(F.broadcast(parts), "part")
    return placed.select("_source", "source_size", (F.col("first") + F.col("at") - 1).alias("number"))


def with_targets(sources: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """``sources`` (written) with ``target``: each weight's part of the words, up to ``most`` times the source's."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights)).cast("int") + 1)
    sized = sources.withColumns({"weight": weight, "limit": most * F.col("source_size")})
    whole = sized.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    each, stopped = 0.0, -1
    while True:  # the part of a unit of weight grows as sources stop at their limits
        full = F.col("limit") <= each * F.col("weight") if stopped >= 0 else F.lit(False)
        sums = sized.agg(
            F.count_if(full).alias("stopped"),
            F.sum(F.when(full, F.col("limit")).otherwise(0)).alias("given"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if sums["stopped"] == stopped or not sums["weight"]:
            break
        stopped = sums["stopped"]
        each = (percent * whole / 100 - sums["given"]) / sums["weight"]
    target = F.least(F.col("limit").cast("double"), F.lit(each) * F.col("weight"))
    return sized.withColumn("target", target).drop("weight", "limit")


def placed_rows(rows: DataFrame, sources: DataFrame, keep: Sequence[str], block_words: int, seed: int) -> DataFrame:
    """One row a copy, with its source's number, size and target, its block and its order within it."""
    named = sources.withColumnRenamed("_source", "_name")
    if sources.count() * _ROW_BYTES <= 64 << 20:
        named = F.broadcast(named)
    copies = each_copy(rows, "copies", "copy")
    copies = copies.join(named, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    content = [F.col("_source"), *map(F.col, keep), F.col("size"), F.col("copy")]
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words))
    return copies.select(
        *["_source", *keep, "size", "source_size", "target", "number"],
        F.pmod(F.xxhash64(F.lit(seed), *content), blocks).alias("block"),
        F.xxhash64(F.lit(seed + 1), *content).alias("order"),
    )


def quotas(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """number, block, at (its place among the ``in_source`` blocks with words), rounds (whole passes), left (words wanted of it in a further pass), words.

    ``left`` is at least the block's words if it is taken whole, and at most 0 if it isn't taken.
    """
    blocks = rows.where("size > 0").groupBy("number", "block").agg(F.sum("size").alias("words"))
    blocks = materialize(blocks.withColumn("group", F.floor(F.col("block") / _GROUP)), "mix-blocks")
    sums = blocks.groupBy("number", "group").agg(F.sum("words").alias("w"), F.count("*").alias("n"))
    before = Window.partitionBy("number").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "number", "group", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"),
        F.sum("n").over(Window.partitionBy("number")).alias("in_source"),
    )
    within = Window.partitionBy("number", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.col("w") + F.coalesce(F.sum("words").over(within), F.lit(0))
    at = F.col("n") + F.count("*").over(within)
    placed = blocks.join(sums, ["number", "group"]).withColumns({"passed": passed, "at": at})
    wanted = sources.select("number", "source_size", F.round("target").cast("long").alias("wanted"))
    placed = join_keys(placed, wanted, "number", "inner", _ROW_BYTES)
    rounds = F.when(F.col("source_size") > 0, F.expr("wanted div source_size")).otherwise(0)
    placed = placed.withColumn("rounds", rounds)
    left = F.col("wanted") - F.col("rounds") * F.col("source_size") - F.col("passed")
    return placed.select("number", "block", "at", "in_source", "rounds", left.alias("left"), "words")


def partly(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """The rows of the blocks in ``cut`` (number, block, left; at most one a source), with ``extra``: whether the further pass takes them."""
    inside = join_keys(rows, cut, ["number", "block"], "inner", _ROW_BYTES)
    inside = inside.withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")))).otherwise(-1).cast("int"))
    upto = Window.partitionBy("number", "class").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = materialize(inside.withColumn("sum", F.sum("size").over(upto)), "mix-cut")
    # A class holds a part of one block, so its sums are few.
    sums = inside.where("class >= 0").groupBy("number", "class").agg(F.collect_list("sum").alias("sums"), F.first("left").alias("left"))
    each = sums.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("class", "sums")), asc=False).alias("classes"), F.first("left").alias("left"))

    def take(state: Column, part: Column) -> Column:
        fits = F.coalesce(F.array_max(F.filter(part["sums"], lambda x: x <= state["left"])), F.lit(0).cast("long"))
        limit = F.struct(part["class"].alias("class"), fits.alias("limit"))
        return F.struct((state["left"] - fits).alias("left"), F.concat(state["limits"], F.array(limit)).alias("limits"))

    start = F.struct(F.col("left").alias("left"), F.expr("cast(array() as array<struct<class: int, limit: bigint>>)").alias("limits"))
    limits = each.select("number", F.explode(F.aggregate("classes", start, take, lambda state: state["limits"])).alias("x")).select("number", "x.*")
    inside = join_keys(inside, materialize(limits, "mix-limits"), ["number", "class"], "left", _ROW_BYTES)
    extra = (F.col("class") >= 0) & (F.col("sum") <= F.col("limit"))
    return inside.withColumn("extra", F.coalesce(extra, F.lit(False))).drop("left", "class", "sum", "limit")


def _log_factorial(x: str) -> str:
    """Logarithm of x!, from Stirling's series beyond 20."""
    series = f"{x} * ln({x}) - {x} + 0.5D * ln(6.283185307179586D * {x}) + 1 / (12D * {x}) - 1 / (360D * {x} * {x} * {x}) + 1 / (1260D * pow({x}, 5))"
    return f"if({x} <= 20, ln(cast(factorial(cast(least({x}, 20) as int)) as double)), {series})"


def _log_choose(n: str, k: str) -> str:
    return " ".join((_log_factorial(f"cast({n} as double)"), "-", _log_factorial(f"cast({k} as double)"), "-", _log_factorial(f"cast({n} - {k} as double)")))


def hypergeometric(whole: str, own: str, drawn: str, uniform: str) -> str:
    """SQL: how many of ``drawn`` draws without replacement out of ``whole`` are among ``own``, for a ``uniform`` number.

    Inversion that starts at the mode and goes outwards, so that some standard deviations are gone through. What is
    left of the uniform number falls by the probability of each value passed.
    """
    # Outer expressions are bound once: a lambda would evaluate them again for each of its elements.
    bound = f"named_struct('a', cast({whole} as bigint), 'k', cast({own} as bigint), 'n', cast({drawn} as bigint), 'u', {uniform})"
    low, high = "greatest(0L, h.n - (h.a - h.k))", "least(h.n, h.k)"
    mode = f"cast(least(greatest(floor((h.n + 1D) * (h.k + 1D) / (h.a + 2D)), {low}), {high}) as bigint)"
    deviation = "sqrt(h.n * (h.k / greatest(cast(h.a as double), 1D)) * ((h.a - h.k) / greatest(cast(h.a as double), 1D)) * ((h.a - h.n) / greatest(h.a - 1D, 1D)))"
    start = f"named_struct('h', h, 'low', {low}, 'high', {high}, 'mode', {mode}, 'width', cast(ceil(14 * {deviation}) as bigint) + 20)"
    m = "g.mode"
    height = f"exp({_log_choose('g.h.k', m)} + {_log_choose('(g.h.a - g.h.k)', f'(g.h.n - {m})')} - ({_log_choose('g.h.a', 'g.h.n')}))"
    up = "s.up * ((g.h.k - g.mode - i + 1D) * (g.h.n - g.mode - i + 1D) / ((g.mode + cast(i as double)) * (g.h.a - g.h.k - g.h.n + g.mode + cast(i as double))))"
    down = "s.down * ((g.mode - i + 1D) * (g.h.a - g.h.k - g.h.n + g.mode - i + 1D) / ((g.h.k - g.mode + cast(i as double)) * (g.h.n - g.mode + cast(i as double))))"
    step = f"""if(s.found is not null, s, get(transform(array(named_struct('up', {up}, 'down', {down})), p -> named_struct(
        'rest', s.rest - p.up - p.down, 'up', p.up, 'down', p.down,
        'found', case when s.rest < p.up then g.mode + i when s.rest - p.up < p.down then g.mode - i end)), 0))"""
    walk = f"""get(transform(array({height}), p0 -> aggregate(
        sequence(1L, greatest(1L, least(g.width, greatest(g.high - g.mode, g.mode - g.low)))),
        named_struct('rest', g.h.u - p0, 'up', p0, 'down', p0, 'found', if(g.h.u < p0, g.mode, cast(null as bigint))),
        (s, i) -> {step},
        s -> coalesce(s.found, g.mode))), 0)"""
    return f"get(transform(transform(array({bound}), h -> {start}), g -> if(g.low = g.high, g.low, {walk})), 0)"


def splitting_tree(spark: SparkSession, amounts: Sequence[int], shards: int, seed: int) -> DataFrame:
    """shard, colour, n: how many of the ``amounts`` draws of each colour a shard gets."""
    draws = sum(amounts)
    start = F.array(*[F.lit(x).cast("long") for x in amounts])
    nodes = spark.range(1).select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), start.alias("held"))

    def upto(shard: str) -> str:
        """Draws of the shards before this one."""
        return f"cast(cast({shard} as decimal(18,0)) * {draws} div {shards} as bigint)"

    uniform = f"shiftrightunsigned(xxhash64({seed}, lo, hi, size(t.parts)), 11) / 9007199254740992D"
    left = f"""aggregate(held, named_struct('whole', {upto("hi")} - {upto("lo")}, 'drawn', {upto("mid")} - {upto("lo")}, 'parts', cast(array() as array<bigint>)),
        (t, own) -> get(transform(array({hypergeometric("t.whole", "own", "t.drawn", uniform)}), x ->
            named_struct('whole', t.whole - own, 'drawn', t.drawn - x, 'parts', concat(t.parts, array(x)))), 0),
        t -> t.parts)"""
    for level in range((shards - 1).bit_length()):
        if level == _ALONE:
            nodes = nodes.repartition(shuffle_partitions(spark), "lo")
        nodes = nodes.withColumn("mid", F.expr("(lo + hi) div 2"))
        nodes = nodes.withColumn("part", F.expr(f"if(hi - lo > 1, {left}, held)"))
        one = F.when(F.col("hi") - F.col("lo") > 1, F.col("mid")).otherwise(F.col("hi"))
        halves = F.array(
            F.struct(F.col("lo"), one.alias("hi"), F.col("part").alias("held")),
            F.struct(one.alias("lo"), F.col("hi"), F.zip_with("held", "part", lambda a, b: a - b).alias("held")),
        )
        nodes = nodes.select(F.explode(halves).alias("x")).select("x.*").where("hi > lo")
    return nodes.select(F.col("lo").alias("shard"), F.posexplode("held").alias("colour", "n"))


def permuted(place: str, size: str, seed: Column | int) -> Column:
    """A keyed permutation of the numbers below ``size``: a Feistel network over a grid a little larger, walked until it is back inside."""
    grid = f"named_struct('a', cast(ceil(sqrt(cast({size} as double))) as bigint), 'b', cast(ceil({size} / ceil(sqrt(cast({size} as double)))) as bigint))"
    rounds = f"""aggregate(sequence(0, 2), named_struct('l', x div g.b, 'r', x % g.b), (p, i) -> get(transform(
        array(pmod(p.l + pmod(xxhash64({seed}, {size}, i, p.r), g.a), g.a)),
        l -> named_struct('l', l, 'r', pmod(p.r + pmod(xxhash64({seed}, {size}, i + 8, l), g.b), g.b))), 0), p -> p.l * g.b + p.r)"""
    walk = f"get(transform(array(y), x -> {rounds}), 0)"
    # What lies outside is less than a row of the grid, and a walk meets it once at most.
    return F.expr(f"""get(transform(array({grid}), g -> aggregate(sequence(0L, g.a + 1), named_struct('y', cast({place} as bigint), 'done', false),
        (w, j) -> if(w.done, w, get(transform(transform(array(w.y), y -> {walk}), z -> named_struct('y', z, 'done', z < {size})), 0)), w -> w.y)), 0)""")


def shard_draws(spark: SparkSession, cut: DataFrame, shard_words: int, words: int, colours: int, seed: int) -> DataFrame:
    """number, block, rounds and draws: an element (pass, shard) for each draw of the block. ``cut`` is written."""
    draws = cut.withColumn("times", F.col("rounds") + (F.col("left") > 0).cast("long")).where("times > 0")
    sums = draws.groupBy("number").agg(F.sum("times").alias("n")).withColumn("colour", (F.col("number") % colours).cast("int"))
    sums = materialize(sums, "mix-quotas")
    amounts = {row["colour"]: row["n"] for row in sums.groupBy("colour").agg(F.sum("n").alias("n")).collect()}  # at most ``colours`` rows
    if not amounts:
        return spark.createDataFrame([], "number long, block long, rounds long, draws array<struct<epoch: long, shard: long>>")
    amounts = [amounts.get(c, 0) for c in range(colours)]
    shards = max(1, min(sum(amounts), -(-words // shard_words)))
    tree = materialize(splitting_tree(spark, amounts, shards, seed), "mix-tree")
    before = Window.partitionBy("colour").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = tree.withColumn("from", F.coalesce(F.sum("n").over(before), F.lit(0))).where("n > 0").withColumn("to", F.col("from") + F.col("n"))
    # Runs and draws meet in stretches of a colour about as long as a run.
    sizes = F.element_at(F.array(*[F.lit(x).cast("long") for x in amounts]), F.col("colour") + 1)
    stretch = F.greatest(F.lit(1).cast("long"), F.floor(sizes / shards))
    runs = runs.select("shard", "colour", "from", "to", F.explode(F.sequence(F.floor(F.col("from") / stretch), F.floor((F.col("to") - 1) / stretch))).alias("stretch"))

    of_colour = Window.partitionBy("colour").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(sums.select("number", "colour", F.coalesce(F.sum("n").over(of_colour), F.lit(0)).alias("base")), "mix-bases")
    each = draws.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    # Passes follow each other; in the further pass only the first blocks are drawn.
    draw = F.col("base") + F.col("epoch") * F.col("in_source") + F.col("at")
    each = join_keys(each, bases, "number", "inner", _ROW_BYTES).withColumns({"draw": draw, "in_colour": sizes})
    each = each.withColumn("to_place", permuted("draw", "in_colour", seed + 2))
    each = each.withColumn("stretch", F.floor(F.col("to_place") / stretch)).drop("draw", "in_colour", "base", "at", "in_source")
    met = each.join(runs, ["colour", "stretch"]).where((F.col("to_place") >= F.col("from")) & (F.col("to_place") < F.col("to")))
    return met.groupBy("number", "block", "rounds").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("draws"))


def mix(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = (5, 2, 1),
    percent: int = 150,
    most: int = 2,
    block_words: int = 1 << 16,
    shard_words: int = 1 << 24,
    colours: int = 64,
    seed: int = 0,
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The kept columns, size, source_size, target, draws and order of every row: it is in the mix once for each of its ``draws`` (pass and shard)."""
    if clash := sorted({c.lower() for c in keep} & {*_ADDED, "_source"}):
        raise ValueError(f"kept columns are named like added ones: {', '.join(clash)}")
    spark = docs.sparkSession
    counted = materialize(counted_rows(docs, keep, text, source), "mix-rows")
    sources = materialize(numbered_sources(counted), "mix-numbered")
    sources = materialize(with_targets(sources, weights, percent, most), "mix-targets")
    rows = materialize(placed_rows(counted, sources, keep, block_words, seed), "mix-placed")
    cut = materialize(quotas(rows, sources), "mix-cuts")
    words = int(sources.agg(F.sum("target").alias("n")).first()["n"] or 0)
    draws = materialize(shard_draws(spark, cut, shard_words, words, colours, seed), "mix-draws")

    split = materialize(cut.where("left > 0 and left < words").select("number", "block", "left"), "mix-split")
    whole = join_keys(rows, split.select("number", "block"), ["number", "block"], "left_anti").withColumn("extra", F.lit(True))
    both = whole.unionByName(partly(rows, split))
    found = join_keys(both, draws, ["number", "block"], "left", _ROW_BYTES)
    # A row that the further pass leaves out keeps the whole passes.
    drawn = F.filter("draws", lambda d: F.col("extra") | (d["epoch"] < F.col("rounds")))
    drawn = F.when((F.col("size") > 0) & F.col("draws").isNotNull(), drawn).otherwise(F.expr("cast(array() as array<struct<epoch: bigint, shard: bigint>>)"))
    return found.select(*keep, "size", "source_size", "target", drawn.alias("draws"), "order")


def shuffled(mixed: DataFrame, seed: int = 0) -> DataFrame:
    """One row for each draw of each row of a mix, with its shard and its place in it, shards shuffled and brought together."""
    drawn = mixed.withColumn("x", F.explode("draws")).withColumns({"shard": F.col("x.shard"), "epoch": F.col("x.epoch")})
    drawn = drawn.withColumn("order", F.xxhash64(F.lit(seed + 3), "order", "epoch"))
    within = Window.partitionBy("shard").orderBy("order")
    kept = [c for c in mixed.columns if c not in ("draws", "order", "source_size", "target")]
    return drawn.withColumn("place", F.row_number().over(within) - 1).select("shard", "place", *kept)
