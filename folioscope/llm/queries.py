"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import (
    bpe,
    conversations,
    filter_audit,
    html_text,
    jaccard_join,
    langid,
    leaks,
    licences,
    nearest,
    packing,
    private,
    repeats,
    suffix_tree,
)
from folioscope.llm.common import LOWER_SQL, UPPER_SQL, is_held_out, open_docs, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: The vocabulary of the encoding query; the file belongs to the box and is never copied.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: The same vocabulary as the tokenizers library reads it, for the packing query.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Key of the registered pseudonyms; a real run takes its own from a secret store.
PRIVATE_KEY = "folioscope"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(open_docs(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = open_docs(spark, sf_dir).select("doc_id", "text", "lang", is_held_out(F.col("doc_id"), 5).alias("held_out"))
    labelled = docs.where("not held_out").select(F.col("doc_id").alias("key"), "text", "lang")
    found = langid.predict(docs.select("doc_id", "text", "held_out"), langid.fit(labelled))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = open_docs(spark, sf_dir).select("doc_id", "text", is_held_out(F.col("doc_id"), 10).alias("held_out"))
    model, vocabulary = suffix_tree.fit(docs.where("not held_out"))
    return suffix_tree.score(docs, model, vocabulary)


@query
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(open_docs(spark, sf_dir).select("doc_id", "text")).drop("text")


@query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = open_docs(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages, html_text.fit(pages)).drop("html")


@query
def op7_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.pseudonymise(open_docs(spark, sf_dir).select("doc_id", "text"), PRIVATE_KEY)


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(open_docs(spark, sf_dir), words=3, share=90)


@query
def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(open_docs(spark, sf_dir).select("doc_id", "text"))


@query
def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.pairs(open_docs(spark, sf_dir), open_docs(spark, sf_dir, "benchmark"))


@query
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = open_docs(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.trie(open_docs(spark, sf_dir, "conversations"))


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(open_docs(spark, sf_dir), VOCABULARY, public_tokenizers.PATTERN))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.mask_counts(open_docs(spark, sf_dir), open_docs(spark, sf_dir, "labels"))
    return filter_audit.audit(store(counts, "mask-counts"))


_LETTERS = f"'{UPPER_SQL}', '{LOWER_SQL}'"

ORACLE["op10_jaccard_join"] = rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS words
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(words) = 0 THEN []
             WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
        END) AS shingle
    FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared JOIN sizes nx ON nx.doc_id = x JOIN sizes ny ON ny.doc_id = y
    WHERE 100 * common >= 90 * (nx.n + ny.n - common)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, w.y FROM reached r JOIN ways w ON w.x = r.other)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id
GROUP BY r.doc_id"""

ORACLE["op13_filter_audit"] = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM words GROUP BY t),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
marked AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
            100 * length(regexp_replace(words.t, '[^A-Z]', '', 'g')) > 2 * length(words.t),
            regexp_matches(words.t, '[#$%&*|]'), coalesce(words.doc_id > least, false)] AS fails
    FROM words JOIN firsts ON firsts.t = words.t LEFT JOIN known ON known.doc_id = words.doc_id),
counted AS (SELECT part, fails, good, toxic, count(*) AS n FROM marked GROUP BY ALL),
item AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM item a, item b, item c, item d, item e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
played AS (
    SELECT part, o, s.i AS step, o[s.i] AS item, fails, good, toxic, n,
           coalesce(nullif(list_position(list_transform(o, lambda x: fails[x]), true), 0), 6) AS gone
    FROM counted, orders, item s),
steps AS (
    SELECT part, o, step, item, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
           sum(n) FILTER (fails[item] AND gone < step) AS redundant,
           sum(n) FILTER (fails[item] AND len(list_filter(fails, lambda f: f)) = 1) AS unique_fails,
           sum(n) FILTER (gone = step AND good) AS good_lost, sum(n) FILTER (gone = step AND toxic) AS toxic_lost
    FROM played GROUP BY ALL)
SELECT part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, item) AS BIGINT) AS shapley
FROM steps"""

# CRC-32 written out: a byte at a time, eight shifts each
ORACLE["op11_conversation_trie"] = """
WITH ordered AS (
    SELECT conv_id,
           list({'role': r, 'text': t} ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || t)) AS turns
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL) c
    GROUP BY conv_id),
heads AS (
    SELECT conv_id, turns,
           xor(list_reduce(
               [4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
               lambda a, x: list_reduce([xor(a, x)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                                        lambda b, y: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295) % 9 AS h
    FROM ordered),
rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS seq
    FROM heads o LEFT JOIN heads b ON b.conv_id = o.conv_id - o.conv_id % 5),
nodes AS (
    SELECT prefix, len(prefix) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(strlen(any_value(prefix)[len(prefix)].text), 0) AS n_bytes
    FROM (SELECT conv_id, seq[1:d] AS prefix FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt) u) p
    GROUP BY prefix),
children AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
sums AS (
    SELECT prefix[1:k] AS prefix, sum(CASE WHEN childless THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * n_bytes) AS saved
    FROM (SELECT n.*, c.n IS NULL AS childless, unnest(range(0, n.depth + 1)) AS k
          FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix) a
    GROUP BY ALL),
ends AS (SELECT seq AS prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS digest FROM rebuilt GROUP BY seq)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes n
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]
LEFT JOIN children c ON c.prefix = n.prefix
JOIN sums s ON s.prefix = n.prefix
LEFT JOIN ends e ON e.prefix = n.prefix"""
