"""Registered queries of the text operators, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.llm import (chat, decontamination, divergence, jaccard, language, lines, middle, mixing, pii,
                           secret_scan, syncmers, tokens, toxicity)
from wellspark.llm.shared import fold

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Every window that lines up a shingle with its place in an item is held against all items of its
# size, by counts of equal shingles.
_LEAKS = r"""
WITH split AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
    SELECT side, id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM split),
items AS (SELECT id AS item_id, w, len(w) AS m, least(len(w), 5) AS size FROM words WHERE side = 'i' AND len(w) > 0),
item_places AS (
    SELECT item_id, m, size, q, array_to_string(w[q + 1:q + size], ' ') AS g
    FROM (SELECT *, unnest(range(0, m - size + 1)) AS q FROM items)),
doc_places AS (
    SELECT doc_id, size, places, p, array_to_string(w[p + 1:p + size], ' ') AS g
    FROM (SELECT id AS doc_id, size, w, len(w) - size + 1 AS places, unnest(range(0, len(w) - size + 1)) AS p
          FROM words, (SELECT DISTINCT size FROM items) WHERE side = 'd')),
starts AS (
    SELECT DISTINCT doc_id, m, size, places, greatest(0, least(p - q, places - (m - size + 1))) AS start
    FROM doc_places JOIN item_places USING (size, g)),
ours AS (
    SELECT doc_id, m, size, start, places, g, count(*) AS c FROM starts JOIN doc_places USING (doc_id, size, places)
    WHERE p BETWEEN start AND start + m - size GROUP BY ALL),
theirs AS (SELECT item_id, m, size, g, count(*) AS c FROM item_places GROUP BY ALL),
common AS (
    SELECT doc_id, item_id, m, size, start, places, CAST(sum(least(ours.c, theirs.c)) AS BIGINT) AS k
    FROM ours JOIN theirs USING (m, size, g) GROUP BY ALL),
likeness AS (
    SELECT doc_id, item_id, start, k / (least(m - size + 1, places) + m - size + 1 - k) AS similarity FROM common)
SELECT doc_id, item_id, similarity, CAST(start AS INT) AS start FROM likeness WHERE similarity >= 0.75
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

# The sets are compared pair by pair in DuckDB; chains of links are followed by a recursive query.
_JACCARD = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
same AS (SELECT list_sort(s) AS s, min(doc_id) AS one FROM sets WHERE len(s) > 0 GROUP BY 1),
ones AS (SELECT items.* FROM items JOIN same ON items.doc_id = same.one),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, count(*) AS common
    FROM ones a JOIN ones b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL),
links AS (
    SELECT x, y FROM shared WHERE 100 * common >= 75 * (n + m - common)
    UNION SELECT one, doc_id FROM sets JOIN same ON list_sort(sets.s) = same.s
    UNION SELECT doc_id, one FROM sets JOIN same ON list_sort(sets.s) = same.s),
reach AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x)
SELECT sets.doc_id, len(any_value(s)) AS n_shingles, min(other) AS component_id
FROM sets JOIN reach USING (doc_id) GROUP BY sets.doc_id
"""

_LINES = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
often AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (often.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often ON keyed.key = often.key GROUP BY doc_id
"""

_MIDDLE = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
drawn AS (
    SELECT *, CAST('0x' || substr(key, 1, 8) AS BIGINT) % (len(w) + 1) AS x,
           CAST('0x' || substr(key, 9, 8) AS BIGINT) % (len(w) + 1) AS y,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR CAST('0x' || substr(key, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                WHEN CAST('0x' || substr(key, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cut),
parts AS (
    SELECT doc_id, text, len(w) AS n, form, array_to_string(w[1:least(x, y)], '') AS p,
           array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(w[greatest(x, y) + 1:], '') AS s
    FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

# Every kept term is held against every other source and the language, whether it occurs there or not.
_SOURCES = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
           coalesce(source, '') AS source FROM documents),
words AS (
    SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
vocabulary AS (SELECT lang, term, count(*) AS l FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 3),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN vocabulary USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
own AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
langs AS (SELECT lang, sum(l) AS n_lang, count(*) AS v FROM vocabulary GROUP BY lang),
grid AS (
    SELECT lang, source, term, coalesce(c, 0) AS c,
           1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 1)) // (coalesce(n, 0) + v) AS p,
           1 + (CAST(1000000000 AS HUGEINT) * (l + 1)) // (n_lang + v) AS q
    FROM groups JOIN vocabulary USING (lang) JOIN langs USING (lang)
    LEFT JOIN counts USING (lang, source, term) LEFT JOIN own USING (lang, source)),
against AS (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM grid x JOIN grid y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN against ON against.lang = a.lang AND against.source = a.source AND against.item = b.source
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM grid WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""


@query("op1_chat_formatting")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_conversations(table(spark, folder, "conversations"))


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, tokens.load_vocabulary(VOCABULARY)).drop("text")


@query("op3_pii")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    out = pii.personal_data(table(spark, folder, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op4_benchmark_decontamination", _LEAKS)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start")


@query("op5_document_fingerprints")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.edited_fingerprints(table(spark, folder, "documents"))


@query("op6_ngram_jaccard_join", _JACCARD)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op7_line_dedup", _LINES)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_language_id")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, folder, "labels"))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


@query("op10_source_mixing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, folder, "documents"))


@query("op11_fill_in_middle", _MIDDLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    out = middle.fill_in_middle(table(spark, folder, "documents"))
    text = middle.restore(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(text, 256).alias("restored_sha256"))


@query("op12_secret_scan")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    out = secret_scan.find_secrets(table(spark, folder, "documents"))
    base = secret_scan.in_text(F.col("found"))
    counts = [F.size(secret_scan.in_text(F.col("found"), k)).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS]
    return out.select("doc_id", *counts, F.sha2(secret_scan.spans(base), 256).alias("base_sha256"),
                      secret_scan.spans(F.col("found")).alias("spans"))


@query("op13_source_divergence", _SOURCES)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit_sources(table(spark, folder, "documents"))
