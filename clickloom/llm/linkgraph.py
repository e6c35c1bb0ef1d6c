"""URL filters: rules by host and path, and for the rest trust and distrust spread over host links.

Trust is a personalised PageRank from hosts with allowed pages along links; distrust one from hosts with
blocked pages against them, as who links to bad hosts is suspect. Both walks run together: one table of
edges holds the links and, marked as the other kind, their reverses, and a round is one join and one
sum. A host is blocked if its distrust is over ``ratio`` times its trust.

Scores are whole parts of MASS, so sums don't depend on their order and the result is the same on every
run. Edges are summed to one per pair of hosts before anything else moves. Each round is written down:
the next one's join then reads both sides through a shuffle, in which adaptive execution splits a host
with very many links, and a lost executor costs one round at most.

A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed. Null html
has no links. Links of a host to itself don't count. Repeated pages count as often as they occur, in
seeds and links alike. Without pages there are no rows; without seeds or links, scores are those of the
seeds alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import lower_ascii
from clickloom.sources.tables import materialize

#: Total score of a walk.
MASS = 10**15
#: The host of a link in markup or text, which a quote, a bracket or a blank ends as well.
_LINK = r"""://([^/?#"'<>\x20\x09-\x0D]*)"""
#: Marks that end a sentence, not a host.
_MARKS = ".,;:!)]}"
#: A host named outside links: labels of letters, digits, hyphens and underscores, from where the first begins.
_NAME = r"(?<![\p{L}\p{N}_-])[\p{L}\p{N}_-]++(?:\.[\p{L}\p{N}_-]++)++"

Rule = tuple[str, str, str]  # verdict, host, path


def parse_rule(text: str, verdict: str) -> Rule:
    """``host/path`` as a rule."""
    host, slash, path = text.partition("/")
    return verdict, host, slash + path


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text = F.when(fits, F.lit(name + start)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def with_rules(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and rule_verdict."""
    out = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    text, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return out.withColumns({"rule": text, "rule_verdict": verdict})


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """src, dst, links: other hosts of the table that a host's pages name, in links or in plain text.

    The target of a link has the whole host, with port and user, as a page's url has; a name in plain text is
    taken whole too, so ``my_shop.net`` is no mention of ``shop.net``.
    """
    hosts = pages.select("host").where(F.col("host") != "").distinct()
    links = F.transform(F.regexp_extract_all(html, F.lit(_LINK), F.lit(1)), lambda x: F.rtrim(x, F.lit(_MARKS)))
    bare = F.regexp_extract_all(F.regexp_replace(html, _LINK, " "), F.lit(_NAME), F.lit(0))
    names = F.array_distinct(F.transform(F.concat(links, bare), lower_ascii))
    named = pages.where((F.col("host") != "") & F.col(html).isNotNull()).select(
        F.col("host").alias("src"), F.explode(names).alias("dst")
    )
    counted = named.where(F.col("src") != F.col("dst")).groupBy("src", "dst").agg(F.count("*").alias("links"))
    return counted.join(hosts.withColumnRenamed("host", "dst"), "dst", "left_semi").select("src", "dst", "links")


def propagate(links: DataFrame, seeds: DataFrame, rounds: int = 8, damping: float = 0.85) -> DataFrame:
    """host, kind (0 trust, 1 distrust) and score after ``rounds`` rounds.

    ``seeds``: host, kind and weight (a count). A round keeps ``1 - damping`` of the mass on the seeds and
    passes the rest on in proportion to the links.
    """
    edges = links.select("src", "dst", "links", F.lit(0).alias("kind")).unionByName(
        links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links", F.lit(1).alias("kind"))
    )
    out = edges.groupBy("src", "kind").agg(F.sum("links").alias("all_links"))
    edges = materialize(edges, "link-edges")
    out = materialize(out, "link-degrees")
    edges = materialize(
        edges.join(out, ["src", "kind"]).select(
            "src", "dst", "kind", (F.lit(damping) * F.col("links") / F.col("all_links")).alias("share")
        ),
        "link-shares",
    )
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    start = materialize(
        seeds.join(F.broadcast(total), "kind").select(  # two rows
            "host", "kind", F.floor(F.lit(float(MASS)) * F.col("weight") / F.col("total")).cast("long").alias("score")
        ),
        "link-seeds",
    )
    base = start.withColumn("score", F.floor(F.lit(1.0 - damping) * F.col("score")).cast("long"))
    scores = start
    for step in range(rounds):
        passed = scores.withColumnRenamed("host", "src").join(edges, ["src", "kind"])
        passed = passed.select(F.col("dst").alias("host"), "kind", F.floor(F.col("score") * F.col("share")).cast("long").alias("score"))
        scores = passed.unionByName(base).groupBy("host", "kind").agg(F.sum("score").alias("score"))
        scores = materialize(scores, f"link-scores-{step}")
    return scores


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html", key: str = "page_id", ratio: float = 1.0) -> DataFrame:
    """key, host, path, rule, verdict of every page."""
    placed = with_rules(pages.select(F.col(key), F.col(url), F.col(html)), rules, url)
    links = materialize(host_links(placed, html), "host-links")
    placed = materialize(placed.select(key, "host", "path", "rule", "rule_verdict"), "pages-placed")
    seeds = (
        placed.where(F.col("rule").isNotNull())
        .groupBy("host", (F.col("rule_verdict") == "block").cast("int").alias("kind"))
        .agg(F.count("*").alias("weight"))
    )
    scores = propagate(links, materialize(seeds, "link-weights"))
    trust = F.sum(F.when(F.col("kind") == 0, F.col("score")).otherwise(0))
    distrust = F.sum(F.when(F.col("kind") == 1, F.col("score")).otherwise(0))
    bad = scores.groupBy("host").agg(trust.alias("trust"), distrust.alias("distrust"))
    bad = materialize(bad.where(F.col("distrust") > ratio * F.col("trust")).select("host", F.lit(True).alias("bad")), "bad-hosts")
    # Only pages without a rule ask for their host, so the others stay out of the join's keys.
    asked = F.when(F.col("rule").isNull() & (F.col("host") != ""), F.col("host"))
    judged = placed.withColumn("asked", asked).join(bad.withColumnRenamed("host", "asked"), "asked", "left")
    found = F.coalesce("rule_verdict", F.when(F.col("bad"), "block"), F.lit("allow"))
    return judged.select(key, "host", "path", "rule", found.alias("verdict"))
