"""Near duplicates, toxicity, neighbours, packing, main text and repeated substrings against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionweave.llm import maintext, neardup, neighbours, packing, queries, substrings, toxicity
from motionweave.llm.textbytes import word_hashes

SF = "/root/testdata/sf0.001"
ODD = [None, "", "  ", "word", "two words", "a b c d", "a b c d e", "A, b. C d E", "été " * 7, "x" * 3000, "same line\n" * 300, "😀 😀 a"]


def with_odd(spark, name="documents"):
    own = spark.read.parquet(f"{SF}/{name}.parquet").select("doc_id", "text")
    rows = [(None if i == 1 else 10**6 + i, t) for i, t in enumerate(ODD)] + [(10**6 + 9, ODD[9])]
    return own.unionByName(spark.createDataFrame(rows, own.schema)).withColumn("key", F.lit(1)).withColumn("whole", F.lit(2)).withColumn("id", F.lit(3))


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def grams_of(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_classes(rows):
    """Least id of each component of pairs with Jaccard similarity of at least 0.8, by comparing all pairs."""
    sets = [grams_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            least[find(i)].append(ident)
    return [(ident, min(least[find(i)], default=None) if sets[i] else ident) for i, (ident, _) in enumerate(rows)]


def near_copies(n, seed=3):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.sample(range(200), 3):
            w[k] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates(spark):
    docs = with_odd(spark)
    more = spark.createDataFrame([(2 * 10**6 + i, t) for i, t in enumerate(near_copies(60))], "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(plain_classes(rows), key=key)


def test_one_of_each(spark):
    docs = with_odd(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {(i, t) for (i, t), (_, c) in zip(rows, plain_classes(rows), strict=True) if i == c or not words_of(t)}
    got = neardup.one_of_each(docs)
    assert got.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(want)


def test_near_duplicates_with_other_repeat_counts(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        w = [f"r{i}x{k}" for k in range(204)]
        other = list(w)
        for k in rng.sample(range(60, 200), 2):
            other[k] = f"z{rng.randrange(10**6)}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other + other[:44] * 50))]
    got = [tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(plain_classes(rows)) and len({c for _, c in got}) == 60


def test_registers_estimate_the_probability_jaccard():
    a = np.array([1, 2, 3, 4, 5, 6], np.uint64) * np.uint64(0x9E3779B97F4A7C15 % 2**64)
    b = np.r_[a[:4], np.array([91, 92], np.uint64)]
    wa, wb = np.array([1.0, 2, 3, 1, 1, 1]), np.array([1.0, 1, 3, 2, 1, 2])
    m = 4000
    sig = neardup.signatures(np.r_[np.zeros(6, int), np.ones(6, int)], np.r_[a, b], np.r_[wa, wb], 2, m)
    every = {int(k): [0.0, 0.0] for k in np.r_[a, b]}
    for k, w in zip(a, wa):
        every[int(k)][0] = w
    for k, w in zip(b, wb):
        every[int(k)][1] = w
    want = sum(1 / sum(max(x / px if px else np.inf if x else 0, y / py if py else np.inf if y else 0) for x, y in every.values())
               for px, py in every.values() if px and py)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_word_hashes_follow_the_words():
    texts = ["Ab cd", "", "ab", "é1-É1 cD", "cd"]
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(r) for r in raw])]
    h, row, _, _ = word_hashes(offsets, np.frombuffer(b"".join(raw), np.uint8))
    want = [(i, w) for i, t in enumerate(texts) for w in words_of(t)]
    assert [i for i, _ in want] == row.tolist()
    by = defaultdict(set)
    for x, (_, w) in zip(h.tolist(), want):
        by[w].add(x)
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)


def plain_segments(score):
    """Maximal scoring segments by definition: the best segment, then the same to its left and right."""
    if len(score) == 0 or max(score) <= 0:
        return []
    best = max(((sum(score[i:j]), i - j, -i) for i in range(len(score)) for j in range(i + 1, len(score) + 1)))
    i = -best[2]
    j = i - best[1]
    return plain_segments(score[:i]) + [(i, j)] + [(a + j, b + j) for a, b in plain_segments(score[j:])]


def test_segments():
    rng = np.random.default_rng(1)
    for _ in range(60):
        score = rng.normal(-0.3, 1, rng.integers(1, 25))
        found = toxicity.segments(score)
        assert [(a, b) for a, b, _ in found] == plain_segments(list(score))
        best = toxicity.best_segments(score, np.zeros(len(score), int), 1)[0]
        assert abs(best - max([s for _, _, s in found], default=0)) < 1e-9


def test_toxicity_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op3_toxicity(spark, sf)
    truth = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    got = rows.where("held_out").join(truth, "doc_id").toPandas()
    pos, neg = got[got.toxic == 1].score.to_numpy(), got[got.toxic == 0].score.to_numpy()
    area = (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()
    hit = (got.predicted == 1) & (got.toxic == 1)
    print("area", area, "precision", hit.sum() / max(1, got.predicted.sum()), "recall", hit.sum() / got.toxic.sum())
    assert area > 0.85


def test_toxicity_of_odd_texts(spark):
    docs = with_odd(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.5}


def brute_neighbours(ids, x, k=5):
    out = {}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i, ident in enumerate(ids):
        if ident % 50 == 0:
            s = unit @ unit[i]
            order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-round(s[j], 12), ids[j]))[:k]
            out[ident] = [ids[j] for j in order]
    return out


def test_neighbours_recall(spark):
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        own = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
        want = brute_neighbours(own.vec_id.tolist(), np.array(own.embedding.tolist(), float))
        got = defaultdict(list)
        for r in queries.op4_nearest_neighbours(spark, sf).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append(r["vec_id"])
        assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
        recall = np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want])
        print(sf, recall)
        assert recall >= 0.9


def test_neighbours_of_lone_queries_among_tight_groups(spark):
    """The groups set a small radius; the queries lie by themselves, so their neighbours are far beyond it."""
    rng = np.random.default_rng(3)
    groups = np.repeat(rng.normal(size=(300, 96)), 7, axis=0) + 0.02 * rng.normal(size=(2100, 96))
    lone = rng.normal(size=(42, 96)) + 0.3
    ids = np.arange(len(groups) + len(lone))
    x = np.empty((len(ids), 96))
    x[ids % 50 != 0] = groups[:(ids % 50 != 0).sum()]
    asks = (ids % 50 == 0).sum()
    x[ids % 50 == 0] = np.concatenate([lone, rng.normal(size=(asks, 96))])[:asks] * np.where(np.arange(asks) % 2, 1.0, 1e200)[:, None]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in ids[ids % 50 == 0].tolist():
        score = unit @ unit[q]
        score[q] = -2
        assert got[q] == np.argsort(-score)[:5].tolist()


def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (50, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("x")).withColumn("query", F.lit(1))
    got = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in
           neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 50, 1.0), (0, 3, 2, 0.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 2, 0.0)]
    assert neighbours.nearest(df.limit(0), F.lit(True)).collect() == []


def test_directory_finds_every_code():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 2**63, 800, dtype=np.uint64)
    d = neighbours.Directory(codes, 64)
    for radius in (0, 5, 20, 27):
        for c in codes[:20]:
            assert d.within(c, radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ c) <= radius).tolist()


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = with_odd(spark).unionByName(spark.createDataFrame([(77, "a <|endoftext|> b")], "doc_id long, text string"), allowMissingColumns=True)
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in docs.collect():
        want[r["doc_id"], tuple(exact.encode(r["text"] or "", add_special_tokens=False).ids + [1])] += 1
    pieces = packing.pack(docs.repartition(3)).collect()
    at = defaultdict(lambda: defaultdict(list))
    sequences = defaultdict(list)
    for p in pieces:
        ids = np.array(p["ids"], "<u4")
        assert zlib.crc32(ids.tobytes()) == p["ids_crc32"] and len(ids) == p["length"] > 0
        at[p["doc_id"], p["doc_tokens"]][p["start"]].append(ids.tolist())
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
        padding += 0 if end & (end - 1) == 0 else 2048 - end
    assert padding == 0
    assert sum(p["length"] for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    for (ident, ids), n in want.items():
        starts = at[ident, len(ids)]
        if n == 1 and sum(1 for i, other in want if i == ident and len(other) == len(ids)) == 1:
            assert [t for s in sorted(starts) for t in starts[s][0]] == list(ids)


def test_packing_balances_cost():
    rng = np.random.default_rng(0)
    pieces = [packing.Piece(i, 0, np.zeros(n, "<u4")) for i, n in enumerate(rng.integers(1, 1500, 400))]
    packed, rest = packing.assign(pieces)
    assert all(sum(len(p.ids) for p in s) == packing.CAPACITY for s in packed) and sum(len(p.ids) for p in rest) < packing.CAPACITY
    cost = lambda s: sum(packing.cost(len(p.ids)) for p in s)
    mixed = list(pieces)
    random.Random(0).shuffle(mixed)
    plain, room = [[]], 2048
    for p in mixed:
        while len(p.ids):
            head, p = p.cut(min(room, len(p.ids)))
            plain[-1].append(head)
            room -= len(head.ids)
            if room == 0:
                plain.append([])
                room = 2048
    assert np.std([cost(s) for s in packed]) < np.std([cost(s) for s in plain[:-1]])


PAGE = ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body><header>Site name here.</header>"
        "<nav><ul><li><a href='/a'>menu one</a></li></ul></nav><!-- ad --><div class=\"ad\">Buy this, now. It is good.</div><div class='cookie-notice'>We use cookies.</div>"
        "<article><h1>Title &amp; more</h1><p><b>First   paragraph, with\n text &quot;quoted&quot;. And more, yes.<br><p>Second one, a <a href='x'>link</a> inside.</p>"
        "<p>Short.</p><form><p>Name: <input></p></form><div class='comments'><p>I disagree, strongly. Really.</p></div></article>"
        "<aside>Related, things. More.</aside><footer>&copy; somebody &middot; Some text, here. And more.</footer></body></html>")


@pytest.mark.parametrize("page,text", [
    (PAGE, 'Title & more\n\nFirst paragraph, with text "quoted". And more, yes.\n\nSecond one, a link inside.\n\nShort.'),
    (PAGE.replace("article", "div"), 'Title & more\n\nFirst paragraph, with text "quoted". And more, yes.\n\nSecond one, a link inside.\n\nShort.'),
    (None, ""), ("", ""), ("plain text only", "plain text only"), ("<p>a<p>b", "a\n\nb"), ("<script>x", ""), ("<div><p>un<b>closed", "unclosed"),
    ("<p>a &lt; b &#228; &nbsp; c</p>", "a < b ä c"), ("< 3 and <", "< 3 and <"),
])
def test_main_text(spark, page, text):
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string").withColumn("markup", F.lit(1)).withColumn("text", F.lit(2))
    (row,) = maintext.extract(df).collect()
    assert row["text"] == text


def sentences(n, word):
    return " ".join(f"This is {word}, sentence {k}, and it goes on." for k in range(n))


@pytest.mark.parametrize("page", [
    "<body><div><h4>Name</h4><p>{0}</p><section><p>{1}</p><p>{1}</p><p>{1}</p></section><p>{2}</p></div></body>",
    "<body><article><h4>Name</h4><p>{0}</p></article><article><p>{1}</p><p>{1}</p><p>{1}</p></article><p>{2}</p></body>",
    "<body><table><tr><td><h4>Name</h4><p>{0}</p></td><td><p>{1}</p><p>{1}</p><p>{1}</p><p>{2}</p></td></tr></table></body>",
])
def test_sections_drop_nothing(page):
    parts = [sentences(3, "intro"), sentences(12, "body"), sentences(3, "outro")]
    text, _ = maintext.main_text(page.format(*parts))
    assert text == "\n\n".join(["Name", parts[0], *[parts[1]] * 3, parts[2]])


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><p>{0}</p>{1}</body>", "<body><main class='content with-sidebar'><p>{0}</p></main>{1}</body>",
    "<body><div id='page' class='no-comments'><article><p>{0}</p></article>{1}</div></body>",
    "<body><article class='post share'><p>{0}</p></article>{1}</body>", "<body><form id='aspnet'><div><p>{0}</p>{1}</div></form></body>",
    "<body><div class='wrap with-menu'><p>{0}</p></div>{1}</body>",
    "<body><div class='has-widgets'><form><main class='share'><p>{0}</p></main></form></div>{1}</body>",
])
def test_names_of_containers_exclude_nothing(page):
    body = sentences(12, "body")
    aside = f"<div class='comments'><p>{sentences(3, 'comment')}</p></div><form><p>{sentences(2, 'form')}</p></form><nav>Menu.</nav>"
    assert maintext.main_text(page.format(body, aside))[0] == body


def test_long_comments_beside_an_article_stay_out():
    body = sentences(3, "body")
    page = f"<main><article><p>{body}</p></article><div class='comments'><p>{sentences(30, 'comment')}</p></div></main>"
    assert maintext.main_text(page)[0] == body


def test_pages_hold_their_article(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").join(queries.op7_main_text(spark, SF).select("page_id", "text", "n_chars"), "page_id").collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [re.sub(r"\s+", " ", maintext.html.unescape(re.sub(r"</?b>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", inside)]
        assert r["text"] == "\n\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])


def plain_removal(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int(np.sum(gone & ~np.r_[False, gone[:-1]])) if len(gone) else 0
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("length,seed,crowd", [(24, 1, 10**6), (24, 2, 3), (40, 3, 0)])
def test_repeated_substrings(spark, monkeypatch, length, seed, crowd):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [word(rng.randrange(10, 90)) for _ in range(8)]
    texts = ["".join(rng.choice([word(rng.randrange(0, 60)), rng.choice(shared)]) for _ in range(rng.randrange(0, 8))) for _ in range(80)]
    texts += [None, "", "a" * 200, "ab" * 90, "a" * (length - 1), texts[0], texts[1], texts[1]]
    spans = substrings.repeated_spans
    monkeypatch.setattr(substrings, "repeated_spans", lambda t, n: spans(t, n, 8, crowd))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("digest", F.lit(1)).withColumn("spans", F.lit(2))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in substrings.remove_repeats(docs, length=length).collect()}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts, length)


def test_repeated_substrings_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id")
    want = plain_removal([r["text"] for r in docs.collect()], 400)
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op8_repeated_substrings(spark, SF).orderBy("doc_id").collect()]
    assert got == want


@pytest.mark.parametrize("name", ["op2_near_duplicates", "op3_toxicity", "op6_pack_sequences", "op8_repeated_substrings"])
def test_empty_table(spark, tmp_path, name):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.queries()[name](spark, str(tmp_path)).collect() == []


def test_empty_pages_and_embeddings(spark, tmp_path):
    for t in ("pages", "embeddings"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.op7_main_text(spark, str(tmp_path)).collect() == []
    assert queries.op4_nearest_neighbours(spark, str(tmp_path)).collect() == []
