"""The operators over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import bpe, divergence, feistel, gam, lexical, licences, linkgraph, minhash, mixing, packing, rules, topk, warc
from clickloom.llm.common import table
from clickloom.sources.tables import fresh_path, materialize

Query = Callable[[SparkSession, str], DataFrame]


#: Score from which a document is taken for good.
QUALITY_THRESHOLD = 0.3


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels outside the held-out fifth."""
    labels = table(spark, sf_dir, "labels")
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def op1_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back: payload size and digest, record type, reference.

    A revisit's payload is its response's: sizes and digests are looked up by the response's identifier.
    A record that could not be read whole has null size and digest.
    """
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    read = warc.read_archives(spark, path).select(
        F.col("page").try_cast("long").alias("page_id"),  # empty for rows without an id
        "record_id",
        "record_type",
        "refers_to_id",
        F.octet_length("payload").cast("long").alias("bytes"),
        F.sha1("payload").alias("digest"),
        "status",
    )
    read = materialize(read, "warc-read")
    responses = read.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_to_id"),
        F.col("page_id").alias("refers_to"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
    )
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status"]
    revisits = read.where(F.col("record_type") == "revisit").join(responses, "refers_to_id", "left").select(*fields)
    own = read.where(F.col("record_type") == "response").select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
        "status",
    )
    return own.unionByName(revisits)


def op3_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all other vectors for every fiftieth one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


#: Key of the pseudonyms in the queries; a real run takes its own from a secret store.
PSEUDONYM_KEY = "clickloom"


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal numbers and dates replaced, and how many there were."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return feistel.pseudonymise(docs, PSEUDONYM_KEY, replaced="n_replaced")


#: The rules of the URL query. Fixed values.
URL_RULES = [
    linkgraph.parse_rule("org/", "allow"),
    linkgraph.parse_rule("example.org/es/", "block"),
    linkgraph.parse_rule("example.org/en/1", "block"),
    linkgraph.parse_rule("com/fr/", "allow"),
    linkgraph.parse_rule("com/de/", "block"),
]


def op4_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return linkgraph.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every text, and the digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(ids, path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_fast_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at a similarity of 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, as a file below its source: a directory for each digit of its id but the last two."""
    number = F.col("doc_id").cast("string")
    folders = F.when(F.length(number) > 2, F.regexp_replace(F.expr("left(doc_id, length(doc_id) - 2)"), "([0-9])", "$1/")).otherwise("")
    path = F.concat(F.coalesce("source", F.lit("unknown")), F.lit("/"), folders, number, F.lit(".txt"))
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return licences.scan(files, keep=("doc_id",))


def op8_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces and their places in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_additive_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, by a model that has not seen the held-out fifth of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = gam.train(docs, training_labels(spark, sf_dir))
    return gam.score(docs, model, ["doc_id"]).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every text, and whether it passes the base rules and the learned list."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    statistics = materialize(rules.with_statistics(docs).drop("text"), "statistics")
    judged, _ = rules.judge(statistics, training_labels(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_splitting_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes, and the shards they go to."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("draws")).alias("taken"),
        F.transform("draws", lambda d: d["shard"]).alias("shards"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of each source from the others of its language, and the terms that set it apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def _link_graph_sql(rounds: int = 8) -> str:
    """The link graph round by round: scores are whole numbers, so both engines sum them alike."""
    steps = "".join(
        f"""
        s{i + 1} as materialized (
            select host, kind, sum(score)::bigint as score from (
                select e.dst as host, e.kind, floor(s.score * e.share)::bigint as score
                from s{i} s join edges e on e.src = s.host and e.kind = s.kind
                union all select host, kind, floor(0.15000000000000002::double * score)::bigint from s0
            ) group by host, kind
        ),"""
        for i in range(rounds)
    )
    link = r"""'://([^/?#"''<>\x20\x09-\x0D]*)'"""
    name = r"'[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)+'"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
        with cut as (
            select page_id, html, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages
        ),
        placed as materialized (
            select page_id, html, {lower.format("regexp_extract(rest, '^[^/?#]*')")} as host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
            from cut
        ),
        rules(verdict, name, start) as (
            values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
        ),
        ruled as materialized (
            select page_id, any_value(host) as host, any_value(path) as path, any_value(html) as html,
                max_by(name || start, length(name || start)) as rule, max_by(verdict, length(name || start)) as verdict
            from placed left join rules
                on (host = name or ends_with(host, '.' || name)) and starts_with(path, start)
            group by page_id
        ),
        named as (
            select distinct page_id, src, {lower.format("dst")} as dst from (
                select page_id, host as src, rtrim(unnest(regexp_extract_all(html, {link}, 1)), '.,;:!)]}}') as dst from ruled
                union all
                select page_id, host, unnest(regexp_extract_all(regexp_replace(html, {link}, ' ', 'g'), {name})) from ruled
            ) where src <> ''
        ),
        links as (
            select src, dst, count(*) as n from named
            where src <> dst and dst in (select host from ruled where host <> '') group by src, dst
        ),
        both_ways as (
            select src, dst, n, 0 as kind from links union all select dst, src, n, 1 from links
        ),
        edges as materialized (
            select src, dst, kind, 0.85::double * n / sum(n) over (partition by src, kind) as share from both_ways
        ),
        seeds as (
            select host, (verdict = 'block')::int as kind, count(*) as w from ruled where rule is not null group by all
        ),
        s0 as materialized (
            select host, kind, floor(1e15::double * w / sum(w) over (partition by kind))::bigint as score from seeds
        ),{steps}
        bad as (
            select host from s{rounds} group by host
            having sum(case when kind = 1 then score else 0 end) > sum(case when kind = 0 then score else 0 end)
        )
        select page_id, host, path, rule,
            coalesce(verdict, case when host <> '' and host in (select host from bad) then 'block' else 'allow' end) as verdict
        from ruled
    """


QUERIES: dict[str, Query] = {
    "op1_warc_roundtrip": op1_warc_roundtrip,
    "op2_feistel_pseudonyms": op2_feistel_pseudonyms,
    "op3_pivot_topk": op3_pivot_topk,
    "op4_link_graph": op4_link_graph,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_fast_sketch_dedup": op6_fast_sketch_dedup,
    "op7_licence_scan": op7_licence_scan,
    "op8_bin_completion": op8_bin_completion,
    "op9_additive_model": op9_additive_model,
    "op10_quality_rules": op10_quality_rules,
    "op11_splitting_tree": op11_splitting_tree,
    "op12_lexical_search": op12_lexical_search,
    "op13_level_products": op13_level_products,
}

ORACLES: dict[str, str] = {
    "op4_link_graph": _link_graph_sql(),
    "op1_warc_roundtrip": """
        with sized as (
            select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
            from pages
        ),
        numbered as (
            select *, max(page_id) over (partition by payload_digest, payload_bytes) as last_id from sized
        )
        select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
            case when payload_bytes >= 1000 and page_id <> last_id then 'revisit' else 'response' end as record_type,
            case when payload_bytes >= 1000 and page_id <> last_id then last_id end as refers_to, 'ok' as status
        from numbered
    """,
    "op6_fast_sketch_dedup": r"""
        with recursive tokens as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') as words
            from documents
        ),
        shingles as (
            select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle
            from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from tokens where len(words) > 0)
        ),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        common as (
            select x.doc_id as a, y.doc_id as b, count(*) as shared
            from shingles x join shingles y on x.shingle = y.shingle and x.doc_id < y.doc_id
            group by all
        ),
        links as (
            select a, b from common join sizes s on s.doc_id = a join sizes t on t.doc_id = b
            where 100 * shared >= 85 * (s.n + t.n - shared)
        ),
        either as (select a, b from links union all select b, a from links),
        reach as (
            select doc_id as a, doc_id as b from documents
            union
            select reach.a, either.b from reach join either on reach.b = either.a
        ),
        groups as (select a as doc_id, min(b) as component_id from reach group by a)
        select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
        from groups left join sizes using (doc_id)
    """,
    "op3_pivot_topk": """
        with vectors as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        pairs as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
            from vectors q join vectors c on q.vec_id <> c.vec_id
            where q.vec_id % 50 = 0
        ),
        ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from pairs
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
    "op12_lexical_search": r"""
        with tokens as (
            select doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents
        ),
        postings as materialized (select doc_id, term, count(*) as tf from tokens group by all),
        lengths as materialized (select doc_id, sum(tf) as n from postings group by all),
        totals as materialized (select count(*) as n_docs, sum(n) as n_terms from lengths),
        weights as materialized (
            select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
            from postings, totals group by term, n_docs
        ),
        asked as (
            select item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ),
        scored as (
            select item_id, doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))))::bigint as score
            from asked join weights using (term) join postings using (term) join lengths using (doc_id), totals
            group by all
        ),
        ranked as (
            select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
            from scored where score > 0
        )
        select item_id, rank, doc_id, score from ranked where rank <= 20
    """,
    "op13_level_products": r"""
        with docs as (
            select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as doc,
                regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
            from documents
        ),
        held as materialized (select lang, source, doc, unnest(terms) as term from docs),
        kept as materialized (select lang, term from held group by all having count(distinct doc) >= 3),
        counts as materialized (select lang, source, term, count(*) as n from held join kept using (lang, term) group by all),
        wholes as materialized (select lang, term, sum(n) as n from counts group by all),
        langs as materialized (select lang, count(*) as v, sum(n) as n from wholes group by all),
        groups as materialized (
            select d.lang, d.source, coalesce(c.n, 0) as n, coalesce(l.v, 0) as v, coalesce(l.n, 0) as lang_n
            from (select distinct lang, source from docs) d
            left join (select lang, source, sum(n) as n from counts group by all) c on c.lang = d.lang and c.source = d.source
            left join langs l on l.lang = d.lang
        ),
        priced as materialized (
            select g.lang, g.source, w.term, coalesce(c.n, 0) as n,
                (1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.n + g.v))::hugeint as p,
                (1 + (1000000000::hugeint * (w.n + 1)) // (g.lang_n + g.v))::hugeint as q
            from groups g join wholes w on w.lang = g.lang
            left join counts c on c.lang = g.lang and c.source = g.source and c.term = w.term
        ),
        pairs as (
            select x.lang, x.source, 'pair' as part, y.source as item, sum((x.p - y.p) * (x.p - y.p) // y.p) as value
            from priced x join priced y on x.lang = y.lang and x.term = y.term and x.source <> y.source
            group by all
            union all
            select g.lang, g.source, 'pair', h.source, 0 from groups g join groups h on h.lang = g.lang and h.source <> g.source
            where g.v = 0
        ),
        found as (
            select * from pairs
            union all
            select lang, source, 'term', term, (p - q) * (p - q) // q from priced where n > 0 and p > q
        ),
        ranked as (
            select lang, source, part, item, value::bigint as value,
                row_number() over (partition by lang, source, part order by value desc, encode(item))::integer as rank
            from found
        )
        select * from ranked where part = 'pair' or rank <= 200
    """,
}
