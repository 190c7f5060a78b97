"""Queries of the conversation and sharding operators, and SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from . import repair, sharding, trie
from .common import table

GROUP = 100
HEADS = 6


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = cut_lineage(trie.ordered_turns(table(spark, sf_dir, "conversations")))
    c = F.col("conv_id")
    return trie.prefix_trie(*trie.with_shared_heads(ordered, c - c % GROUP, F.crc32(c.cast("string").cast("binary")) % HEADS))


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                       F.lit(None).cast("int").alias("grown_shard"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair.repair(repair.damage(turns))
    all_ = turns.select("conv_id").distinct().withColumn("g", repair.group_key())
    none = F.sha2(F.lit("").cast("binary"), 256)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_.join(fixed, "g", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


# The table of the 32-bit cyclic redundancy check, by its rule, and the check of a list of bytes.
_TABLE = """k AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS k)"""


def _crc(bytes_: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda x, b: xor(x >> 8, k[(xor(x, b) & 255) + 1])), 4294967295)"


def _ascii(text: str) -> str:
    return f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii({text}[i]) AS BIGINT))"


TRIE = f"""
WITH {_TABLE},
t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) - 1 AS pos, m, n FROM (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m, length(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT c, c - c % {GROUP} AS base, {_crc(_ascii('s'))} % {HEADS} AS h FROM (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t), k),
r AS (SELECT c.c, t.pos, m, n FROM c JOIN t ON t.c = c.base AND t.pos < c.h UNION ALL SELECT c.c, t.pos, m, n FROM c JOIN t ON t.c = c.c AND t.pos >= c.h),
w AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, n, string_agg(m, ' ') OVER (PARTITION BY c ORDER BY pos) AS path FROM r),
p AS (SELECT c, d, n, path, coalesce(lag(path) OVER (PARTITION BY c ORDER BY d), '') AS up FROM w UNION ALL SELECT c, 0, 0, '', NULL FROM c),
l AS (SELECT c, max(d) AS last FROM p GROUP BY c),
n AS (SELECT path, any_value(up) AS up, any_value(d) AS d, min(p.c) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
  coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (d = last), '') AS ends FROM p JOIN l ON l.c = p.c GROUP BY path),
x AS (SELECT path, d, conv_id, n_convs, ends, (n_convs - 1) * n AS saved, (SELECT count(*) FROM n AS y WHERE y.up = n.path) AS kids,
  (SELECT y.conv_id FROM n AS y WHERE y.path = n.up) AS parent FROM n)
SELECT x.conv_id, x.d AS depth, x.parent AS parent_conv_id, x.n_convs, x.kids AS n_children, CAST(count(*) FILTER (y.kids = 0) AS BIGINT) AS n_leaves,
  CAST(sum(y.saved) AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM x JOIN x AS y ON y.path = x.path OR x.path = '' OR starts_with(y.path, x.path || ' ')
GROUP BY x.path, x.conv_id, x.d, x.parent, x.n_convs, x.kids, x.ends"""

# The splitter of a shard is the nearest end of the stretch that holds its goal, at the first width within the tolerance.
SHARDS = f"""
WITH {_TABLE},
b AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + {sharding.OVERHEAD} AS size,
  list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes FROM documents),
d AS (SELECT doc_id, size, {_crc('bytes')} AS crc,
  substr(md5(text), 1, {sharding.PART}) || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {sharding.PART}) AS key FROM b, k),
s AS (SELECT sum(size) AS total FROM d),
w AS (SELECT unnest(range({sharding.DIGITS}, {2 * sharding.PART + 1}, {sharding.DIGITS})) AS w),
c AS (SELECT w, probe, bytes, sum(bytes) OVER (PARTITION BY w ORDER BY probe) AS upto FROM (
  SELECT w, substr(key, 1, w) AS probe, sum(size) AS bytes FROM d, w GROUP BY ALL)),
g AS (SELECT i, w, probe, {sharding.SHARDS} * upto - total * i AS over, total * i - {sharding.SHARDS} * (upto - bytes) AS under, total
  FROM c, s, (SELECT unnest(range(1, {sharding.SHARDS})) AS i) WHERE {sharding.SHARDS} * upto >= total * i AND {sharding.SHARDS} * (upto - bytes) < total * i),
f AS (SELECT i, arg_min(probe, w) AS probe, arg_min(under <= over, w) AS low FROM g
  WHERE least(over, under) <= {sharding.TOLERANCE} * total OR w = {2 * sharding.PART} GROUP BY i),
h AS (SELECT doc_id, size, crc, key, (SELECT count(*) FROM f WHERE CASE WHEN low THEN key >= probe ELSE substr(key, 1, length(probe)) > probe END) AS shard FROM d)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY key) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard FROM h"""

_S = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _best(*ways: str) -> str:
    return f"least({', '.join(ways)})" if len(ways) > 1 else ways[0]


def _add(state: str, cost: str, letter: str) -> str:
    """A way to a state as text, cost before letters, so that the least text is the cheapest way and then the least audit."""
    return f"(printf('%012d', CAST({state}[1:12] AS BIGINT) + {cost}) || {state}[13:] || '{letter}')"


def _inserted(table_: str) -> str:
    """States o, s, u, a after up to two inserted turns."""
    u1 = _best("u", _add("o", "2", "I"), _add("s", "2", "I"), _add("a", "2", "I"))
    return f"SELECT * REPLACE ({_best('a', _add('u', '2', 'I'))} AS a) FROM (SELECT * REPLACE ({u1} AS u, {_best('a', _add('u', '2', 'I'))} AS a) FROM {table_})"


# Forward steps over the rows: of every state the cheapest way there, of equally cheap ones the least audit.
_FAR = "999999999000"
_KEEP = {"s": {"s": "o"}, "u": {"u": "osa"}, "a": {"a": "u"}}


def _step(to: str) -> str:
    ways = [_add(to, "3", "D")]
    renamed = {"u": "osa", "a": "u"}.get(to, "")
    ways += [f"CASE WHEN code = 'd' THEN NULL ELSE {_add(q, '2 + cut', 'R')} END" for q in renamed]
    ways += [f"CASE WHEN code = '{to}' THEN {_add(q, 'cut', 'K')} END" for q in _KEEP.get(to, {}).get(to, "")]
    return _best(*ways)


REPAIR = f"""
WITH RECURSIVE {_TABLE},
h AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, {_crc(_ascii('s'))} % 20 AS hit FROM (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations), k),
e AS (SELECT conv_id, coalesce('=' || conv_id, '-') AS g, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
  CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, md5(length(role) || ':' || role || text) AS tie, copy
  FROM (SELECT *, unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE hit <> 0)),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, tie, copy) AS i FROM e),
f AS (SELECT *, right(rtrim(text, {_S}), 1) AS last, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS nth, lag(role) OVER (PARTITION BY g ORDER BY i) AS before FROM p),
r AS (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM f),
c AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' ELSE role[1] END AS code, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut FROM r),
n AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (before IS NOT NULL AND before[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS rows FROM c GROUP BY g),
d AS (SELECT g, 0 AS i, '000000000000' AS o, '{_FAR}' AS s, '{_FAR}' AS u, '{_FAR}' AS a FROM n
  UNION ALL
  SELECT g, i, {', '.join(f'{_step(q)} AS {q}' for q in 'osua')} FROM (SELECT w.g, c.i, code, cut, o, s, u, a FROM ({_inserted('d')}) w JOIN c ON c.g = w.g AND c.i = w.i + 1)),
b AS (SELECT g, least(o, a) AS best FROM ({_inserted('d')}) w JOIN n USING (g) WHERE i = rows),
l AS (SELECT g, j, best[12 + j] AS letter, best[13:] AS audit FROM (SELECT g, best, unnest(range(1, length(best) - 11)) AS j FROM b)),
m AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY g ORDER BY j) AS i, count(*) FILTER (letter <> 'D') OVER (PARTITION BY g ORDER BY j) AS out,
  length(replace(audit, 'D', '')) AS turns FROM l),
t AS (SELECT m.g, m.j, CASE WHEN letter = 'K' THEN c.role WHEN (turns - out) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE c.text END AS turn
  FROM m LEFT JOIN c ON c.g = m.g AND c.i = m.i WHERE letter <> 'D'),
z AS (SELECT g, string_agg(turn, chr(10) ORDER BY j) AS repaired FROM t GROUP BY g),
q AS (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '-') AS g FROM conversations)
SELECT conv_id, {', '.join(f'coalesce({x}, 0) AS {x}' for x in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))},
  coalesce(CAST(best[1:12] AS BIGINT), 0) AS cost, coalesce(best[13:], '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM q LEFT JOIN n USING (g) LEFT JOIN b USING (g) LEFT JOIN z USING (g)"""

QUERIES = {f.__name__: f for f in (op11_conversation_trie, op12_shards, op13_conversation_repair)}
ORACLE_SQL = {"op11_conversation_trie": TRIE, "op12_shards": SHARDS, "op13_conversation_repair": REPAIR}
