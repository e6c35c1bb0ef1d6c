"""Licence scans: sparse TF-IDF cosine to licence notices, then inheritance from the nearest directory.

Terms are lower-case runs of letters and digits. The vocabulary is that of the templates; a term's weight
is its count times ln((1 + N) / (1 + df)) + 1, df being counted over all documents. Terms of no template
weigh as much as a template's term on average. Units are the lines of a text (headers), the text as a whole
(licence files), and, for notices that share a line with other words or go over several, its sentences and
the runs of a template's length around the template's heaviest terms, across line ends. A unit can only reach
the threshold if it has one of a template's heaviest terms, those without which the rest of the template falls
short of it, so only such units and texts are broken up. Which terms of any template a text has is found in one
pass over all texts; what follows reads the candidates' texts alone.

A file has the licence of its best line, if that reaches ``header_at``. A text that as a whole reaches
``file_at`` is the licence file of its directory (of several the most similar counts). A file that is neither
has the licence of its best sentence or run that reaches ``header_at``. Other files inherit from the nearest
directory above them that has one. Directories are joined with their ancestors, not
files, and files then with directories: the joins' sides are tables, so a directory with a third of all
files is split like any hot key, or the directories are broadcast if Spark finds them small.

Beside the notices there are whole licence texts, which texts as a whole are compared with, and standard file
headers, which runs of their length are compared with; both have a vocabulary and weights of their own. Of
texts only those are broken up that have as many different uncommon terms of a template as the threshold
takes. An SPDX line states the licences it names (without -only, -or-later or +), like a line of cosine 1.

Ties go to the licence first in alphabet. Null or empty texts have no licence of their own but inherit.
Rows without a path get none. Rows with the same path are one file: their lines are taken together, and
each row gets the file's result. Empty tables give empty results. Extra columns are left out, except
those named in ``keep``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import join_keys
from clickloom.sources.tables import materialize

#: Notices of common licences. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def _folder(name: str) -> dict[str, str]:
    files = resources.files(__package__).joinpath(name).iterdir()
    return {f.name.removesuffix(".txt"): f.read_text() for f in sorted(files, key=lambda f: f.name)}


#: Licence texts, and standard file headers (of short licences the text itself). Fixed values.
TEXTS, HEADERS = _folder("licence_texts"), _folder("licence_headers")
#: Share of all documents from which a term counts as common.
COMMON = 0.02

HEADER_AT, FILE_AT = 0.8, 0.5
_SENTENCE_END = r"(?<=[.!?;:])\s+|\n\s*\n"
_BETWEEN = r"[^\p{L}\p{N}]+"


def terms_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _BETWEEN), "")


def known_terms(files: DataFrame, vocabulary: list[str], path: str, text: str) -> DataFrame:
    """path, known (the distinct terms of the vocabulary in the text) and spdx (whether it may have an SPDX line) of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    # A list of literals is looked up in a hash set; an array would be hashed anew for every row.
    known = F.array_distinct(F.filter(_terms(body), lambda t: t.isin(vocabulary)))
    return files.select(F.col(path).alias("path"), known.alias("known"), body.rlike(_SPDX_MARK).alias("spdx"))


def term_counts(known: DataFrame) -> dict[str, int]:
    """Documents with each term of the vocabulary, and all under ''."""
    counted = known.select(F.explode(F.concat("known", F.array(F.lit("")))).alias("term")).groupBy("term").count()
    return {row["term"]: row["count"] for row in counted.collect()}


def term_weights(counts: dict[str, int], templates: dict[str, str]) -> dict[str, float]:
    """Weight of each term of the templates."""
    total = counts.get("", 0)
    return {t: math.log((1 + total) / (1 + counts.get(t, 0))) + 1 for t in vocabulary_of(templates)}


def vocabulary_of(*templates: dict[str, str]) -> list[str]:
    return sorted({t for some in templates for notice in some.values() for t in terms_of(notice)})


def template_vectors(templates: dict[str, str], weights: dict[str, float]) -> dict[str, dict[str, float]]:
    """Unit vectors of the templates."""
    out = {}
    for name, notice in templates.items():
        vector = {t: n * weights[t] for t, n in Counter(terms_of(notice)).items()}
        length = math.sqrt(sum(x * x for x in vector.values()))
        out[name] = {t: x / length for t, x in vector.items()}
    return out


def _heaviest(vector: dict[str, float], least: float) -> list[str]:
    out, rest = [], 1.0
    for term, x in sorted(vector.items(), key=lambda item: (-item[1], item[0])):
        if math.sqrt(max(rest, 0.0)) < least - 1e-9:
            break
        out.append(term)
        rest -= x * x
    return out


def anchors(vectors: dict[str, dict[str, float]], least: float) -> list[str]:
    """Terms of which a unit has at least one, if its cosine with any template reaches ``least``."""
    return sorted({term for vector in vectors.values() for term in _heaviest(vector, least)})


def uncommon(vectors: dict[str, dict[str, float]], counts: dict[str, int], least: float) -> tuple[list[str], int]:
    """Uncommon terms, and of how many different ones a unit has at least, if its cosine with any template reaches ``least``."""
    names: set[str] = set()
    needed = []
    for vector in vectors.values():
        reach, rare = 0.0, dict(vector)
        for term in sorted(vector, key=lambda t: (-counts.get(t, 0), t)):
            share = vector[term] ** 2
            if counts.get(term, 0) <= COMMON * counts.get("", 0) or reach + share >= least * least / 2:
                break
            reach += share
            del rare[term]
        names |= set(rare)
        heaviest = sorted((x * x for x in rare.values()), reverse=True)
        n = 0
        while n < len(heaviest) and math.sqrt(reach) < least - 1e-9:
            reach += heaviest[n]
            n += 1
        needed.append(n)
    return sorted(names), min(needed)


def runs_of(terms: Column, templates: dict[str, str], vectors: dict[str, dict[str, float]], least: float) -> Column:
    """The runs of terms that lie as a template would, judged by the first place of one of its heaviest terms."""
    places: dict[str, set[tuple[int, int]]] = {}
    for name, notice in templates.items():
        words = terms_of(notice)
        for term in _heaviest(vectors[name], least):
            places.setdefault(term, set()).add((words.index(term), len(words)))
    entries = [
        x
        for term, ways in sorted(places.items())
        for x in (F.lit(term), F.array(*[F.struct(F.lit(i).alias("before"), F.lit(n).alias("n")) for i, n in sorted(ways)]))
    ]
    table, names = F.create_map(*entries), F.array(*[F.lit(t) for t in sorted(places)])
    found = F.transform(terms, lambda t, i: F.struct(t.alias("term"), i.alias("at")))
    found = F.filter(found, lambda x: F.array_contains(names, x["term"]))

    def around(x: Column) -> Column:
        start = lambda way: F.greatest(x["at"] - way["before"], F.lit(0))
        return F.transform(F.element_at(table, x["term"]), lambda way: F.struct(start(way).alias("start"), way["n"].alias("n")))

    runs = F.array_distinct(F.flatten(F.transform(found, around)))
    return F.transform(runs, lambda x: F.slice(terms, x["start"] + 1, x["n"]))


def similarities(units: DataFrame, vectors: dict[str, dict[str, float]], weights: dict[str, float]) -> DataFrame:
    """path, unit, licence and cosine of the best template, for units (path, unit, terms)."""
    other = sum(weights.values()) / len(weights)
    spark = units.sparkSession
    rows = [(name, term, x) for name, vector in vectors.items() for term, x in vector.items()]
    template = spark.createDataFrame(rows, "licence string, term string, x double")
    idf = spark.createDataFrame(list(weights.items()), "term string, w double")
    counted = units.select("path", "unit", F.explode("terms").alias("term")).groupBy("path", "unit", "term").agg(F.count("*").alias("tf"))
    # Both small tables have the templates' size.
    weighed = counted.join(F.broadcast(idf), "term", "left").withColumn("y", F.col("tf") * F.coalesce("w", F.lit(other)))
    weighed = materialize(weighed.select("path", "unit", "term", "y"), "licence-weights")
    lengths = weighed.groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("length"))
    products = weighed.join(F.broadcast(template), "term").groupBy("path", "unit", "licence").agg(F.sum(F.col("x") * F.col("y")).alias("product"))
    scored = products.join(lengths, ["path", "unit"]).withColumn("cosine", F.round(F.col("product") / F.col("length"), 9))
    best = F.min(F.struct((-F.col("cosine")).alias("cosine"), F.col("licence"))).alias("best")
    return scored.groupBy("path", "unit").agg(best).select("path", "unit", F.col("best.licence").alias("licence"), (-F.col("best.cosine")).alias("cosine"))


def _best(scored: DataFrame) -> DataFrame:
    """path, licence and cosine of the most similar template."""
    best = F.min(F.struct((-F.col("cosine")).alias("cosine"), F.col("licence"))).alias("best")
    return scored.groupBy("path").agg(best).select("path", F.col("best.licence").alias("licence"), (-F.col("best.cosine")).alias("cosine"))


_SPDX_MARK = "(?i)SPDX-License-Identifier:"
_SPDX_NAME = r"\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*"
_SPDX = rf"(?i)SPDX-License-Identifier:[ \t]*({_SPDX_NAME}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_SPDX_NAME})*)"


def spdx_licences(files: DataFrame, path: str, text: str) -> DataFrame:
    """Licences named in SPDX lines (path, licence, cosine)."""
    known = sorted({*TEMPLATES, *TEXTS, *HEADERS})
    spelled = F.create_map(*[F.lit(x) for name in known for x in (name.lower(), name)])
    named = files.where(F.col(path).isNotNull() & F.col(text).rlike(_SPDX_MARK))
    named = named.select(F.col(path).alias("path"), F.explode(F.regexp_extract_all(F.col(text), F.lit(_SPDX), F.lit(1))).alias("said"))
    said = F.regexp_replace("said", r"(?i)[ \t]+WITH[ \t]+[^ \t]+", "")
    named = named.select("path", F.explode(F.split(said, r"(?i)[ \t]+(?:AND|OR)[ \t]+")).alias("name"))
    name = F.regexp_replace(F.regexp_replace("name", r"[()]|\.+$", ""), r"(?i)(?:-only|-or-later|\+)$", "")
    named = named.select("path", name.alias("name"))
    return named.select("path", F.coalesce(F.element_at(spelled, F.lower("name")), F.col("name")).alias("licence"), F.lit(1.0).alias("cosine"))


def text_licences(texts: DataFrame, vectors: list[dict], weights: list[dict[str, float]], header_at: float, file_at: float) -> tuple[DataFrame, DataFrame]:
    """Licence texts (path, licence, cosine), and standard headers inside texts (the same columns), of candidates (path, body, as_text, as_header)."""
    terms = texts.where("as_text or as_header").select("path", _terms(F.col("body")).alias("terms"), "as_text", "as_header")
    terms = materialize(terms, "licence-likely")
    whole = terms.where("as_text").select("path", F.lit(-1).alias("unit"), "terms")
    whole = similarities(whole, vectors[0], weights[0]).where(F.col("cosine") >= file_at)
    runs = inner_units(terms.where("as_header"), runs_of(F.col("terms"), HEADERS, vectors[1], header_at))
    runs = similarities(runs, vectors[1], weights[1]).where(F.col("cosine") >= header_at)
    return tuple(materialize(x.select("path", "licence", "cosine"), "licence-texts") for x in (whole, runs))


def own_licences(files: DataFrame, path: str, text: str, templates: dict[str, str], header_at: float, file_at: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Licences stated in lines (path, licence, cosine), licence files, and licences stated inside texts (the same columns)."""
    known = materialize(known_terms(files, vocabulary_of(templates, TEXTS, HEADERS), path, text), "licence-known")
    counts = term_counts(known)
    weights = [term_weights(counts, x) for x in (templates, TEXTS, HEADERS)]
    vectors = [template_vectors(x, w) for x, w in zip((templates, TEXTS, HEADERS), weights)]
    in_lines, in_files = anchors(vectors[0], header_at), anchors(vectors[0], file_at)
    needs = [uncommon(v, counts, least) for v, least in zip(vectors[1:], (file_at, header_at))]

    def has(names: list[str], n: int) -> Column:
        return F.size(F.filter("known", lambda t: t.isin(names))) >= n

    asked = {"as_notice": has(in_files, 1), "as_text": has(*needs[0]), "as_header": has(*needs[1]), "spdx": F.col("spdx")}
    wanted = known.where(F.col("path").isNotNull()).groupBy("path").agg(*[F.max(c).alias(name) for name, c in asked.items()])
    wanted = materialize(wanted.where(" or ".join(asked)), "licence-candidates")
    candidates = files.where(F.col(path).isNotNull()).select(F.col(path).alias("path"), F.col(text).alias("body"))
    candidates = join_keys(candidates, wanted, "path", "inner", 128)
    likely = candidates.where("as_notice").select("path", "body")

    def with_anchor(terms: Column, names: list[str]) -> Column:
        return F.arrays_overlap(terms, F.array(*[F.lit(t) for t in names]))

    lines = F.transform(F.split("body", "\n"), lambda line, i: F.struct(i.alias("unit"), _terms(line).alias("terms")))
    lines = F.filter(lines, lambda x: with_anchor(x["terms"], in_lines))
    whole = F.array(F.struct(F.lit(-1).alias("unit"), _terms(F.col("body")).alias("terms")))
    units = likely.select("path", F.explode(F.concat(lines, whole)).alias("x")).select("path", "x.unit", "x.terms")
    scored = materialize(similarities(units, vectors[0], weights[0]), "licence-scores")
    sentences = F.filter(F.transform(F.split("body", _SENTENCE_END), _terms), lambda terms: with_anchor(terms, in_lines))
    inside = inner_units(likely, F.concat(sentences, runs_of(_terms(F.col("body")), templates, vectors[0], header_at)))
    inside = materialize(similarities(inside, vectors[0], weights[0]).where(F.col("cosine") >= header_at), "licence-inner-scores")
    texts, headers = text_licences(candidates, vectors[1:], weights[1:], header_at, file_at)
    in_line = scored.where((F.col("unit") >= 0) & (F.col("cosine") >= header_at)).select("path", "licence", "cosine")
    whole = scored.where((F.col("unit") < 0) & (F.col("cosine") >= file_at)).select("path", "licence", "cosine")
    inside = inside.select("path", "licence", "cosine").unionByName(headers)
    return _best(in_line.unionByName(spdx_licences(candidates.where("spdx"), "path", "body"))), _best(whole.unionByName(texts)), _best(inside)


def inner_units(texts: DataFrame, terms: Column) -> DataFrame:
    """Units (path, unit, terms) of the term lists of each text; equal ones of a path are one."""
    units = texts.select("path", F.explode(F.array_distinct(terms)).alias("terms"))
    return units.select("path", F.array_join("terms", " ").alias("unit"), "terms").distinct()


def directory_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherited(files: DataFrame, licence_files: DataFrame) -> DataFrame:
    """directory and licence of every directory of ``files`` that has a licence file in or above it."""
    best = F.min(F.struct((-F.col("cosine")).alias("cosine"), F.col("licence"))).alias("best")
    given = licence_files.groupBy(directory_of(F.col("path")).alias("above")).agg(best).select("above", F.col("best.licence").alias("licence"))
    given = materialize(given, "licence-directories")
    directories = files.select("directory").distinct()
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")))
    pairs = directories.select("directory", F.explode(above).alias("x")).select("directory", "x.depth", "x.above").distinct()
    nearest = F.max(F.struct("depth", "licence")).alias("x")
    return pairs.join(given, "above").groupBy("directory").agg(nearest).select("directory", F.col("x.licence").alias("from_above"))


def scan(files: DataFrame, path: str = "path", text: str = "text", keep: tuple[str, ...] = (), templates: dict[str, str] = TEMPLATES, header_at: float = HEADER_AT, file_at: float = FILE_AT) -> DataFrame:
    """keep, path, licence and basis (header, file, directory or null) of every row of ``files``."""
    stated, licence_files, inside = own_licences(files, path, text, templates, header_at, file_at)
    stated, licence_files = materialize(stated, "licence-headers"), materialize(licence_files, "licence-files")
    inside = materialize(inside, "licence-inside")
    rows = materialize(files.select(*keep, F.col(path).alias("path"), directory_of(F.col(path)).alias("directory")), "licence-rows")
    above = materialize(inherited(rows, licence_files), "licence-inherited")
    own = stated.select("path", F.col("licence").alias("in_header"))
    whole = licence_files.select("path", F.col("licence").alias("in_file"))
    inner = inside.select("path", F.col("licence").alias("in_text"))
    out = rows.join(own, "path", "left").join(whole, "path", "left").join(inner, "path", "left").join(above, "directory", "left")
    basis = F.when(F.col("in_header").isNotNull(), "header").when(F.col("in_file").isNotNull(), "file")
    basis = basis.when(F.col("in_text").isNotNull(), "header").when(F.col("from_above").isNotNull(), "directory")
    return out.select(*keep, F.col("path").alias(path), F.coalesce("in_header", "in_file", "in_text", "from_above").alias("licence"), basis.alias("basis"))
