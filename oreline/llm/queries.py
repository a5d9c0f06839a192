"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, classifier, fingerprints, jaccard, mixing, neardup, negatives, packing, passages, quality, secrets, spelling, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


_MIX_SQL = r"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS hash FROM documents),
a AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
b AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM a),
c AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, source_size * 3.0::DOUBLE AS lim FROM b),
d AS (SELECT *, lim / weight AS level, (sum(source_size) OVER ())::DOUBLE AS total,
             (sum(lim) OVER (ORDER BY lim / weight, place)) - lim AS before, sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM c),
e AS (SELECT *, (total - before) / rest AS reach FROM d),
f AS (SELECT *, max(CASE WHEN reach <= level THEN reach END) OVER () AS water FROM e),
t AS (SELECT source, source_size, place, total, least(lim, coalesce(water * weight, lim)) AS target FROM f),
r AS (SELECT s.*, t.source_size, t.place, t.total, t.target, row_number() OVER w AS nth,
             sum(size) OVER (PARTITION BY place ORDER BY hash, doc_id ROWS UNBOUNDED PRECEDING) AS upto
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source WINDOW w AS (PARTITION BY place, hash[1:3] ORDER BY hash, doc_id)),
k AS (SELECT *, CASE WHEN target > 0 THEN (copy * source_size + upto)::DOUBLE / target ELSE 0 END AS finish FROM r, (SELECT unnest(range(3)) AS copy)),
q AS (SELECT *, sum(size) OVER (ORDER BY least(floor(finish * 4096), 12288), finish, place, hash[1:3], nth, copy ROWS UNBOUNDED PRECEDING) AS run FROM k)
SELECT doc_id, size, source_size, target, sum(CASE WHEN run <= total AND size > 0 THEN size ELSE 0 END)::BIGINT AS taken
FROM q GROUP BY doc_id, place, hash, nth, size, source_size, target"""


@query("op1_weighted_fair_mixing", _MIX_SQL)
def weighted_fair_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf)).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


_QUALITY_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS run FROM w, unnest(range(1, len(ws) - 6)) AS u(i)),
d AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS covered FROM d, unnest(range(i, i + 8)) AS u(p) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(covered, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
             len(list_filter(ws, lambda x: list_contains([{stop}], lower(x)))) AS n_stop, length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_upper
      FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             CASE WHEN coalesce(word_chars / nullif(n_words, 0)::DOUBLE, 0) NOT BETWEEN 2 AND 14 THEN 'word length'
                  WHEN coalesce(n_symbols / nullif(n_words, 0)::DOUBLE, 0) > 0.1 THEN 'symbols'
                  WHEN coalesce(n_upper / nullif(word_chars, 0)::DOUBLE, 0) > 0.3 THEN 'upper case'
                  WHEN coalesce(n_stop / nullif(n_words, 0)::DOUBLE, 0) < 0.01 THEN 'stop words'
                  WHEN coalesce(n_dup_lines / nullif(n_lines, 0)::DOUBLE, 0) > 0.4 THEN 'repeated lines' END AS failed_rule FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rule IS NULL AS kept, failed_rule
FROM b""".replace("{stop}", ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS))))


@query("op2_quality_rules", _QUALITY_SQL)
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judged(documents(spark, sf)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rule")


@query("op3_repeated_passages")
def repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf))


@query("op4_minhash_near_duplicates")
def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf), width=4, lower=True, percent=80)


@query("op5_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.neighbour_fingerprints(documents(spark, sf))


@query("op6_token_counts")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf))


@query("op7_secret_scans")
def secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random")


_CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL
           SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS nth, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(\||s>|/s>|<SYS>>|</SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g')) AS n,
             length(regexp_replace(regexp_replace(replace(role, '\', '\\'), '<(\||s>|/s>|<SYS>>|</SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g')) AS m FROM o)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + m + length('<|start|>') + length('<|sep|>') + length('<|end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""


@query("op8_chat_formatting", _CHAT_SQL)
def chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"               # the conversation the contract adds
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(chat.chains(rows.unionByName(extra))))


@query("op9_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf))


@query("op10_quality_classifier")
def quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(F.col("doc_id").isNotNull() & ~held_out)
    texts, marks = classifier.labelled_sample(docs, labels, "doc_id", "text", "quality", classifier.SAMPLE_ROWS, classifier.SAMPLE_BYTES)
    scored = classifier.score(docs, classifier.fit(texts, marks))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


_JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id,
                            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS grams FROM w),
c AS MATERIALIZED (SELECT min(doc_id) AS least, array_agg(doc_id) AS members, list_sort(grams) AS grams, len(grams) AS n, row_number() OVER () AS k FROM t GROUP BY list_sort(grams), len(grams)),
g AS MATERIALIZED (SELECT k, n, unnest(grams) AS gram FROM c),
l AS MATERIALIZED (SELECT a.k AS x, b.k AS y FROM g a JOIN g b ON a.gram = b.gram AND a.k < b.k AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
      GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l UNION ALL SELECT k, k FROM c),
reach AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
m AS (SELECT x AS k, min(c.least) AS least FROM reach JOIN c ON c.k = reach.y GROUP BY x)
SELECT u.doc_id, c.n::BIGINT AS n_shingles, CASE WHEN c.n = 0 THEN u.doc_id ELSE m.least END AS component_id
FROM c JOIN m USING (k), unnest(c.members) AS u(doc_id)"""


@query("op11_ngram_jaccard_join", _JACCARD_SQL)
def ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_join(documents(spark, sf))


@query("op12_spelling_variants")
def spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(documents(spark, sf)).select("word", "form", "root", "n", "n_near", "form_n")


_NEGATIVES_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id AS id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INT) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3"""


@query("op13_hard_negatives", _NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(spark.read.parquet(f"{sf}/embeddings.parquet"), label=shifted)
