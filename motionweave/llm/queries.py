"""Queries of the operators over the given tables, and SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import conversation_queries, license as lic, maintext, mixing, neardup, neighbours, packing, quality, secrets, substrings, toxicity
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    x = F.col("license")
    labels = F.array_sort(F.array_union(x["base_labels"], F.transform(x["detections"], lambda d: d["label"])))
    return lic.scan(docs).select(
        "doc_id", x["n_words"].alias("n_words"), F.size(x["base_starts"]).cast("long").alias("n_base"),
        F.array_min(x["base_starts"]).cast("long").alias("first_word"), F.array_max(x["base_starts"]).cast("long").alias("last_word"),
        F.array_join(x["base_labels"], ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), x["score"].alias("score"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs)).select("doc_id", "secrets")
    s = F.col("secrets")
    names = F.array(*[F.lit(k) for k in secrets.KINDS])
    digest = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["order"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter(s, lambda x: x["order"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(digest(F.filter(s, lambda x: x["order"] < 3)), 256).alias("base_sha256"), digest(s).alias("spans"))


def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False).drop("ids")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = F.make_valid_utf8(F.col("kept").cast("string"))  # a cut may fall inside a character
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256",
        (F.col("n_removed") > 0).alias("changed"), left.alias("text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge(docs.select("doc_id", "text", "lang", "source"), carry=["doc_id", "lang", "source"])
    m = F.col("m")
    return judged.select("doc_id", *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                         "base_failed", "kept")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("mix")
    return mixing.mix_slim(table(spark, sf_dir, "documents")).select(
        "doc_id", x["size"].alias("size"), x["source_size"].alias("source_size"), x["target"].alias("target"),
        (x["size"] * x["copies"]).alias("taken"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_near_duplicates, op3_toxicity, op4_nearest_neighbours, op5_secret_scan, op6_pack_sequences, op7_main_text,
    op8_repeated_substrings, op9_quality_rules, op10_mix_sources)} | conversation_queries.QUERIES
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Classes of near duplicates by comparing all texts that share a shingle.
NEAR_DUPLICATES = r"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
g AS (SELECT DISTINCT k, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT k, count(*) AS n FROM g GROUP BY k),
c AS (SELECT a.k AS a, b.k AS b, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.k <> b.k GROUP BY a.k, b.k),
l AS (SELECT c.a, c.b FROM c JOIN n x ON x.k = c.a JOIN n y ON y.k = c.b WHERE c.c >= 0.8 * (x.n + y.n - c.c)),
r(k, root) AS (SELECT k, k FROM t UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.k),
m AS (SELECT r.k, min(t.doc_id) AS class_id FROM r JOIN t ON t.k = r.root GROUP BY r.k)
SELECT t.doc_id, m.class_id FROM t JOIN m ON m.k = t.k"""

_CLASS = ", ".join(f"('{name}', {slack})" for name, (_, _, slack) in quality.MEASURES.items())
_VALUES = ", ".join(f"'{name}': CASE WHEN {under} > 0 THEN {over} * 1000 // {under} ELSE 0 END" for name, (over, under, _) in quality.MEASURES.items())
_LEVEL = """
l{d} AS (SELECT {k} measure, max(total) AS n{d}, min(CASE WHEN cum * 100 >= total * 50 THEN top END) AS mid, min(CASE WHEN cum * 100 >= total * 75 THEN top END) AS up FROM (
  SELECT *, sum(n) OVER (PARTITION BY {k} measure ORDER BY bucket) AS cum, sum(n) OVER (PARTITION BY {k} measure) AS total FROM (
    SELECT {k} measure, bucket, min(top) AS top, sum(n) AS n FROM hist GROUP BY {k} measure, bucket)) GROUP BY {k} measure)"""

QUALITY = rf"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce('=' || lang, '-') AS lang, coalesce('=' || source, '-') AS source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
tri AS (SELECT k, p, gram, count(*) OVER (PARTITION BY k, gram) AS c FROM (
  SELECT k, p, w[p:p + 2] AS gram FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS p FROM t WHERE len(w) > 2))),
cov AS (SELECT k, count(DISTINCT q) AS n_repeat_words FROM (SELECT k, unnest([p, p + 1, p + 2]) AS q FROM tri WHERE c > 1) GROUP BY k),
m AS (
  SELECT t.k, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_capitals,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]'))) AS n_lines,
         len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')))) AS n_kinds,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t LEFT JOIN cov ON cov.k = t.k),
b AS (SELECT *, n_lines - n_kinds AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS (SELECT k, lang, source, base_failed, unnest(map_entries(MAP {{{_VALUES}}})) AS e FROM b),
x AS (SELECT k, lang, source, base_failed, e.key AS measure, CAST(e.value AS BIGINT) AS v, greatest(length(bin(CAST(e.value AS BIGINT))) - 5, 0) AS s FROM v),
hist AS (SELECT lang, source, measure, s * 16 + (v >> s) AS bucket, (((v >> s) + 1) << s) - 1 AS top, count(*) AS n FROM x WHERE NOT base_failed GROUP BY ALL),
{_LEVEL.format(d=0, k='lang, source,')},{_LEVEL.format(d=1, k='lang,')},{_LEVEL.format(d=2, k='')},
slack(measure, slack) AS (VALUES {_CLASS}),
f AS (SELECT l0.lang, l0.source, l0.measure, CASE WHEN n0 >= {quality.LEAST_GROUP} THEN l0.mid + greatest(slack, {quality.WIDTH} * (l0.up - l0.mid))
    WHEN n1 >= {quality.LEAST_GROUP} THEN l1.mid + greatest(slack, {quality.WIDTH} * (l1.up - l1.mid)) ELSE l2.mid + greatest(slack, {quality.WIDTH} * (l2.up - l2.mid)) END AS fence
  FROM l0 JOIN l1 ON l1.lang = l0.lang AND l1.measure = l0.measure JOIN l2 ON l2.measure = l0.measure JOIN slack ON slack.measure = l0.measure),
j AS (SELECT x.k, bool_and(f.fence IS NULL OR x.v <= f.fence) AS inside FROM x LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.measure = x.measure GROUP BY x.k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept FROM b JOIN j ON j.k = b.k"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '-') AS key, len({_WORDS}) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT key, CAST(sum(size) AS DOUBLE) AS source_size, [{', '.join(map(str, mixing.WEIGHTS))}][CAST((row_number() OVER (ORDER BY key = '-', key) - 1) % {len(mixing.WEIGHTS)} + 1 AS INTEGER)] AS weight FROM d GROUP BY key),
c AS (SELECT *, {mixing.MOST} * source_size AS cap FROM s),
lev AS (SELECT *, row_number() OVER o AS rank, ({mixing.SHARE} * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c WINDOW o AS (ORDER BY cap / weight, key)),
fr AS (SELECT *, min(CASE WHEN level < cap / weight THEN rank END) OVER () AS r0 FROM lev),
lv AS (SELECT *, max(CASE WHEN rank = r0 THEN level END) OVER () AS common FROM fr),
tg AS (SELECT key, source_size, CASE WHEN rank >= r0 THEN common * weight ELSE cap END AS target FROM lv),
bd AS (SELECT *, CASE WHEN target >= source_size THEN 1 ELSE 0 END AS copies, CASE WHEN target >= source_size THEN target - source_size ELSE target END AS room FROM tg),
p AS (SELECT key, h >> {mixing.HASH_BITS - mixing.BITS * mixing.ROUNDS} AS prefix, sum(size) AS words FROM d GROUP BY ALL),
q AS (SELECT p.*, bd.room, sum(words) OVER (PARTITION BY p.key ORDER BY prefix) AS cum FROM p JOIN bd ON bd.key = p.key),
e AS (SELECT key, prefix, cum <= room OR (cum - words <= room AND 2 * (room - (cum - words)) >= words) AS more FROM q)
SELECT d.doc_id, d.size, CAST(bd.source_size AS BIGINT) AS source_size, bd.target, d.size * (bd.copies + CASE WHEN e.more THEN 1 ELSE 0 END) AS taken
FROM d JOIN bd ON bd.key = d.key JOIN e ON e.key = d.key AND e.prefix = d.h >> {mixing.HASH_BITS - mixing.BITS * mixing.ROUNDS}"""

# License rules, Markov models, learned log-odds and codes, subword tokens, tag paths and byte positions are beyond SQL;
# tests/llm holds those queries against plain Python.
ORACLE_SQL: dict[str, str] = {"op2_near_duplicates": NEAR_DUPLICATES, "op9_quality_rules": QUALITY, "op10_mix_sources": MIXING} | conversation_queries.ORACLE_SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE_SQL)
