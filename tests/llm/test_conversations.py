"""Trie, repair and shards against plain Python on small, odd and skewed inputs."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from motionweave.llm import conversation_queries as queries, repair, sharding, trie
from motionweave.session import cut_lineage

SCHEMA = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string"


def turn_digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def odd_turns(seed=5):
    """Shared heads, copies, nulls everywhere, equal turns, repeated rows, one conversation with a third of all rows."""
    rng = random.Random(seed)
    said = ["Yes.", "No!", "Why?", "and then", "", None, " \t", "😀.", "é" * 50 + ".", "x" * 100_000]
    rows = []
    for c in [*range(90, 130), 200, 250, 305, -3, -150]:
        for t in range(rng.randrange(0, 9)):
            rows.append((c, None if rng.random() < 0.1 else t // rng.choice([1, 1, 2]),
                         rng.choice(["user", "assistant", "system", None, "", "tool"]) if rng.random() < 0.3 else ("user", "assistant")[t % 2],
                         rng.choice(said[:9])))
    rows += [(400, t, ("user", "assistant")[t % 2], said[t % 3] if t % 7 else f"turn {t}.") for t in range(150)]
    rows += [(500, t, ("user", "assistant")[t % 2], said[t % 3] if t % 7 else f"turn {t}.") for t in range(150)]
    rows += [(None, 1, "user", "lost."), (None, None, None, None), (600, 2, "user", said[9]), (600, 2, "user", said[9]), (600, 2, "user", said[9])]
    return rows


def plain_trie(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, turn_digest(role or "", text or ""), role or "", text or ""))
    for v in convs.values():
        v.sort()
    rebuilt = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = convs.get(c - int(math.fmod(c, 100)), [])[:h]
        rebuilt[c] = [x[3:] for x in head + v[h:]]
    nodes, children = defaultdict(list), defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = sum(saved[k] for k in children[path]) + ((len(nodes[path]) - 1) * len(path[-1][1]) if path else 0)
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(rebuilt[c]) == len(path)))
        yield (min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children[path]), leaves[path], saved[path],
               hashlib.sha256(ends.encode()).hexdigest())


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def build_trie(turns, **how):
    ordered = cut_lineage(trie.ordered_turns(turns))
    c = F.col("conv_id")
    return trie.prefix_trie(*trie.with_shared_heads(ordered, c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6), **how)


@pytest.mark.parametrize("how", [{}, {"span": 4, "limit": 2}])
def test_trie(spark, how):
    rows = odd_turns()
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(1)).withColumn("pos", F.lit("clash")).withColumn("at", F.lit(3))
    assert in_order(build_trie(turns, **how).collect()) == in_order(plain_trie(rows))


def test_trie_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 8)
    rows = odd_turns(6)
    assert in_order(build_trie(spark.createDataFrame(rows, SCHEMA), span=4).collect()) == in_order(plain_trie(rows))


def test_trie_of_copies(spark):
    rows = [(c, t, "user", f"same {t}.") for c in range(0, 9000, 3) for t in range(2)]
    assert in_order(build_trie(spark.createDataFrame(rows, SCHEMA)).collect()) == in_order(plain_trie(rows))


def test_trie_of_nothing(spark):
    assert build_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert build_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []


def test_spilling_queue():
    rng = random.Random(2)
    items = [(-rng.randrange(9), rng.randrange(50), i) for i in range(500)]
    queue = trie.SpillingQueue(limit=7, page=3)
    for x in items:
        queue.push(x)
    assert len(queue.runs) > 10
    for key in sorted({x[:2] for x in items}):
        assert sorted(queue.take(key)) == sorted(x for x in items if x[:2] == key)
    assert list(queue.take((1, 1))) == []


def least_edits(codes):
    """(cost, letters) by trying the cheapest way to every state, row by row."""
    def inserted(ways):
        for _ in range(3):
            for q, (c, a) in list(ways.items()):
                to = repair.ASSISTANT if q == repair.USER else repair.USER
                ways[to] = min(ways.get(to, (10**9, "")), (c + 2, a + "I"))
        return ways

    ways = inserted({repair.START: (0, "")})
    for code in codes:
        after, cut = {}, int(code.isupper())
        for q, (c, a) in ways.items():
            steps = [(q, c + 3, a + "D")]
            if code != "d":
                steps.append((repair.ASSISTANT if q == repair.USER else repair.USER, c + 2 + cut, a + "R"))
                if (code.lower(), q) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)}:
                    steps.append((" sua".index(code.lower()), c + cut, a + "K"))
            for to, cost, letters in steps:
                after[to] = min(after.get(to, (10**9, "")), (cost, letters))
        ways = inserted(after)
    return min(way for q, way in ways.items() if q in (repair.START, repair.ASSISTANT))


def test_auction_and_prices():
    rng = random.Random(1)
    for n in range(40):
        for _ in range(10):
            codes = "".join(rng.choice("suaxSUAXd" if rng.random() < 0.5 else "ua") for _ in range(n))
            assert repair.edits(codes, repair.ENDING, True, (0,))[0] == (least_edits(codes)[1], n and repair.edits(codes, repair.ENDING, True, (0,))[0][1], least_edits(codes)[0])
            arcs, prices = repair.lattice(codes, repair.ENDING, True), repair.first_prices(codes, repair.ENDING)
            repair.auction(arcs, prices, 0)
            assert all(prices[v] <= cost + prices[to] for v in range(len(arcs)) for _, to, cost in arcs[v])
    assert repair.edits("uU" * 32 + "d" * 64, repair.ENDING, True, (0,))[0][2] == least_edits("uU" * 32 + "d" * 64)[0]


def plain_repair(rows):
    convs, ids = defaultdict(list), set()
    for c, t, role, text in rows:
        ids.add(c)
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or "", text or ""
        order = (t is not None, t or 0, turn_digest(role, text))
        text = "" if hit == 1 else "".join(ch for ch in text if ch not in ".!?") if hit == 2 else text
        role = "user" if hit == 4 else role
        convs[c] += [] if hit == 0 else [(*order, copy, t, role, text) for copy in range(2 if hit == 3 else 1)]
    for c in ids:
        turns = [x[4:] for x in sorted(convs[c], key=lambda x: x[:4])]
        seen, codes, faults = set(), "", defaultdict(int)
        for _, role, text in turns:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in ("blank", "duplicate") else code.upper() if fault else code
        numbers = [t for t, _, _ in turns if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, letters = least_edits(codes)
        out, left = [], list(turns)
        for x in letters:
            row = left.pop(0) if x != "I" else None
            if x == "K":
                out.append(row[1:])
            elif x in "RI":
                out.append(("assistant" if out and out[-1][0][:1] == "u" else "user", row[2] if row else ""))
        text = "\n".join(f"{role}:{text}" for role, text in out)
        yield (c, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults["blank"], faults["duplicate"],
               faults["truncated"], illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("segment", [repair.SEGMENT, 3])
def test_repair(spark, tmp_path, segment, monkeypatch):
    rows = odd_turns()
    whole = repair.repair
    monkeypatch.setattr(repair, "repair", lambda turns: whole(turns, segment))
    spark.createDataFrame(rows, SCHEMA).withColumn("g", F.lit(1)).withColumn("audit", F.lit("clash")).write.parquet(f"{tmp_path}/conversations.parquet")
    assert in_order(queries.op13_conversation_repair(spark, str(tmp_path)).collect()) == in_order(plain_repair(rows))


def test_repair_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_conversation_repair(spark, str(tmp_path)).collect() == []


def odd_docs():
    rng = random.Random(4)
    rows = [(i, "word " * rng.randrange(200)) for i in range(600)] + [(1000 + i, "the same text") for i in range(900)]
    rows += [(None, None), (None, ""), (7, "é😀" * 9), (3, "x" * 40_000)] + [(5, "repeated row")] * 500
    return rows


def check_shards(rows, got, shards, tolerance):
    size = lambda t: len((t or "").encode()) + 16
    crc = lambda t: zlib.crc32((t or "").encode())
    assert in_order((d, size(t), crc(t)) for d, t in rows) == in_order(r[:3] for r in got)
    slots, total = defaultdict(list), defaultdict(int)
    for _, n, _, shard, slot in got:
        slots[shard].append(slot)
        total[shard] += n
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(total.values()) / shards, max(size(t) for _, t in rows)
    assert all(abs(total[i] - mean) <= 2 * tolerance * mean + largest for i in range(shards))


@pytest.mark.parametrize("tolerance", [0.0, sharding.TOLERANCE, 0.5])
def test_shards(spark, tolerance):
    rows = odd_docs()
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("shard", F.lit(1)).repartition(5)
    check_shards(rows, [tuple(r) for r in sharding.shard(docs, 8, tolerance).collect()], 8, tolerance)


def test_shards_without_large_rows(spark):
    """Copies and repeated rows hold most bytes and are cut like all others."""
    rows = odd_docs()[:-501] + [(5, "repeated row")] * 3000
    total = defaultdict(int)
    for r in sharding.shard(spark.createDataFrame([x for x in rows if len(x[1] or "") < 9999], DOCS), 8, 0.0).collect():
        total[r["shard"]] += r["size"]
    assert max(total.values()) - min(total.values()) <= 2 * 1100


def test_shards_of_nothing(spark):
    assert sharding.shard(spark.createDataFrame([], DOCS)).collect() == []


def test_sql_on_odd_rows(spark, tmp_path):
    """The SQL agrees where rows have no equal turns."""
    duckdb = pytest.importorskip("duckdb")
    rows = list({(c, t): (c, t, role, text) for c, t, role, text in odd_turns(8) if c is not None}.values())
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame(odd_docs()[:1400], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for name in ("conversations", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    for name, fn in queries.QUERIES.items():
        df = fn(spark, str(tmp_path))
        cur = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL[name]})")
        assert in_order(df.collect()) == in_order(cur.fetchall()), name
