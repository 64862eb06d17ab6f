"""The registered queries of this package, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm import conversations
from wattframe.llm.contamination import audited, contaminated_spans
from wattframe.llm.divergence import source_divergence
from wattframe.llm.exact_dedup import exact_duplicates
from wattframe.llm.extraction import main_texts
from wattframe.llm import language
from wattframe.llm.line_dedup import without_common_lines
from wattframe.llm.mixing import kind_of, mixed, words
from wattframe.llm.ngram_join import linked_components
from wattframe.llm.packing import packed
from wattframe.llm.surrogates import with_surrogates
from wattframe.llm.syncmers import fingerprints
from wattframe.llm.tables import table
from wattframe.llm.url_rules import ALLOW, BLOCK, judged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def added(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return added


@register(
    "op5_exact_dedup",
    r"""
    WITH norm AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
        FROM documents
    ), groups AS (
        SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY body
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM norm JOIN groups USING (body)
    """,
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@register("op2_syncmers")
def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


URL_RULES = [
    (BLOCK, "net/"),
    (ALLOW, "example.net/en/"),
    (BLOCK, "example.com/de/"),
    (ALLOW, "org/fr/"),
]


@register("op4_url_rules")
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: the document that a page's path numbers; low quality or toxic means block."""
    pages = table(spark, sf_dir, "pages")
    named = pages.select(
        "page_id",
        F.regexp_extract("url", r"://[^/?#]*/[a-z]+/(\d{1,18})", 1).try_cast("long").alias("doc_id"),
    )
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = named.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "page_id", F.when(bad, F.lit(BLOCK)).otherwise(F.lit(ALLOW)).alias("label")
    )
    return judged(pages, URL_RULES, labels)


@register("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@register("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), TOKENIZER)


@register("op9_ngram_join")
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(table(spark, sf_dir, "documents"))


def language_model(docs: DataFrame) -> language.Model:
    """Learned from labelled documents outside the held-out fold."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("doc_id").isNotNull())
    return language.fit(rows.where(~language.held_out(F.col("doc_id"))))


@register("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language_model(docs))
    return found.select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


@register("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_common_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "text", "lines_deleted")


#: How far each dimension's shares are levelled: 1 leaves them, 0 makes them equal.
MIX_POWERS = {"source": 0.7, "lang": 0.5, "topic": 0.8}


def balanced(docs: DataFrame) -> DataFrame:
    """Half of the tokens, or as many as the targets let, levelled by ``MIX_POWERS``."""
    text = F.coalesce("text", F.lit(""))
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": kind_of(text)}
    return mixed(docs, dimensions, words(F.col("text")), MIX_POWERS)


@register("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = balanced(table(spark, sf_dir, "documents"))
    return sample.select("doc_id", "source", "lang", "sampling_weight")


#: Whoever runs this on real data brings a key of their own.
SURROGATE_KEY = "example key"


@register("op8_surrogates")
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = with_surrogates(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return replaced.select("doc_id", "text", "n_entities")


@register(
    "op11_source_divergence",
    r"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), words AS (
        SELECT row, lang, source, unnest(terms) AS term FROM docs
    ), kept AS (
        SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 30
    ), langs AS (
        SELECT d.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS total
        FROM (SELECT DISTINCT lang FROM docs) d LEFT JOIN kept k USING (lang) GROUP BY d.lang
    ), here AS (
        SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
    ), groups AS (
        SELECT d.lang, d.source, coalesce(sum(h.n), 0) AS total
        FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN here h USING (lang, source) GROUP BY ALL
    ), p AS (
        SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
            1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 5)) // (g.total + 5 * l.v) AS p,
            1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
        FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
        LEFT JOIN here h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
    ), sums AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL
    ), found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


@register("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")))


@register(
    "op13_benchmark_contamination",
    r"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), sized AS (
        SELECT item_id, w, least(len(w), 10) AS k FROM items WHERE len(w) > 0
    ), windows AS (
        SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2),
            lambda i: array_to_string(w[i:i + k - 1], ' '))) AS body
        FROM sized
    ), places AS (
        SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS place,
            unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS body
        FROM docs, (SELECT DISTINCT k FROM windows) sizes
        WHERE len(w) >= k
    ), found AS (
        SELECT doc_id, place, k, item_id FROM places JOIN windows USING (k, body)
    ), inside AS (
        SELECT doc_id, count(DISTINCT word) AS n_hit
        FROM (SELECT doc_id, unnest(range(place, place + k)) AS word FROM found) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN inside USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op13_benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return audited(found)


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
