"""The native operators against plain Python on small and odd inputs."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from motionweave.llm import license as lic, mixing, quality, queries, secrets
from motionweave.llm.common import before

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "a", " x y", "CC BY cc-by Cc By", "ALL RIGHTS reserved. all rights reserved", "general public license",
       "token=token = abcdefgh", 'Password: "hunter22" passwd:=xx secret=1234567', "AKIA" + "A" * 16 + " AKIA123 AKIAAKIA" + "B" * 20,
       "0123456789abcdef0123456789 deadbeef", "😀 token = 'ffc3105535f423f352535e4ac53b5fefe076ac6d' 😀", "one two three " * 40,
       "line\nline\n\n \nline\nother", "# # % & <a> | $$ **", "MIT License. Released under the MIT License, see the license file",
       "Licensed under the Apache License, Version 2.0 (the License)", "x" * 5000, "word " * 3000, "İ K cc by nc"]


@pytest.fixture(scope="module")
def texts(spark):
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [(None if i % 4 == 0 else 10**6 + i, t, None if i % 3 == 0 else "en", None if i % 5 == 0 else "src1") for i, t in enumerate(ODD + ODD[:4])]
    return own.unionByName(spark.createDataFrame(rows, own.schema)).withColumn("norm", F.lit(1)).withColumn("m", F.lit("clash")).withColumn("bucket", F.lit(2))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_license_base(texts):
    rows = lic.scan(texts).collect()
    assert len(rows) == texts.count()
    for r in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        want, labels = [], set()
        for phrase, label in lic.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
            want += at
            labels |= {label} if at else set()
        got = r["license"]
        assert got["n_words"] == len(words)
        assert sorted(got["base_starts"]) == sorted(want)
        assert got["base_labels"] == sorted(labels)


def test_license_rules(texts):
    compiled = [re.compile(f"(?<= )(?:{x.pattern})(?= )") for x in lic.RULES]
    assert len(lic.RULES) >= 300
    for r in lic.scan(texts).collect():
        low = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", (r["text"] or "").lower()).strip(" ")
        norm = f" {low} "
        found = []
        for rank, (rule, pattern) in enumerate(zip(lic.RULES, compiled, strict=True)):
            if rule.keyword in norm.split():
                for x in pattern.finditer(norm):
                    start = norm[:x.start()].count(" ") - 1
                    found.append((start, start + x[0].count(" ") + 1, rule.priority, rank, rule.label))
        kept = [d for d in found if not any(
            e != d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and (e[:2] != d[:2] or e[2:4] < d[2:4]) for e in found)]
        assert [tuple(d) for d in r["license"]["detections"]] == sorted(kept, key=lambda d: (d[0], -d[1], d[2], d[3]))


def test_every_rule_holds_its_keyword():
    """A rule is gated by a word that its pattern spells out."""
    for rule in lic.RULES:
        assert re.search(rf"(?<![a-z0-9]){rule.keyword}|{rule.keyword[:-1]}\[sc\]e", rule.pattern) or rule.keyword in ("license", "licence"), rule


@pytest.mark.parametrize("text,label", [("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
                                        ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("GNU General Public License, version 3.", "gpl-3"),
                                        ("GPLv3 or later", "gpl-3"), ("All rights reserved.", "reserved")])
def test_license_labels(spark, text, label):
    (row,) = lic.scan(spark.createDataFrame([(text,)], "text string")).collect()
    assert label in [d["label"] for d in row["license"]["detections"]]


def samples(pattern, rng):
    """A random match of a rule's pattern."""
    out = []
    for op, arg in pattern:
        op = str(op)
        if op == "LITERAL":
            out.append(chr(arg))
        elif op == "IN":
            kind, value = rng.choice(arg)
            out.append(chr(value) if str(kind) == "LITERAL" else chr(value[0]) if str(kind) == "RANGE" else "w")
        elif op == "ANY":
            out.append("w")
        elif op == "BRANCH":
            out.append(samples(rng.choice(arg[1]), rng))
        elif op == "SUBPATTERN":
            out.append(samples(arg[3], rng))
        else:
            assert op == "MAX_REPEAT" or op == "MIN_REPEAT", op
            least, most, inner = arg
            out.append("".join(samples(inner, rng) for _ in range(rng.randint(least, min(int(most), least + 2)))))
    return "".join(out)


def test_every_match_passes_the_gate():
    rng = random.Random(1)
    for rule in lic.RULES:
        parsed = re._parser.parse(rule.pattern)
        for _ in range(60):
            text = samples(parsed, rng)
            assert rule.keyword in text.split(), (rule, text)


@pytest.mark.parametrize("text,label", [
    ("0BSD", "bsd-0-clause"), ("FreeBSD license", "bsd-2-clause"), ("RAIL-M 1.0", "openrail-1.0"), ("GFDL 1.3", "gfdl-1.3"), ("GNU FDL 1.2", "gfdl-1.2"),
    ("ASL 2.0", "apache-2.0"), ("Artistic 2.0", "artistic-2.0"), ("CeCILL 2.1", "cecill-2.1"), ("LGPLv2", "lgpl-2"), ("ELv2", "elastic-2.0")])
def test_short_names_are_found(spark, text, label):
    (row,) = lic.scan(spark.createDataFrame([(text,)], "text string")).collect()
    assert label in [d["label"] for d in row["license"]["detections"]]


def test_secret_base(texts):
    ratio = secrets.train(texts)
    for r in secrets.scan(texts, ratio).collect():
        t, want = r["text"] or "", []
        patterns = {"assign": (re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""), 2),
                    "access": (re.compile(secrets.ACCESS), 0), "hex": (re.compile(secrets.HEX), 0)}
        for order, (kind, (pattern, group)) in enumerate(patterns.items()):
            want += [(x.start(), order, x.end()) for x in pattern.finditer(t) if len(x[group]) >= secrets.LEAST[kind]]
        got = [(s["start"], s["order"], s["end"]) for s in r["secrets"] if s["order"] < 3]
        assert got == sorted(want)
        assert [s["start"] for s in r["secrets"]] == sorted(s["start"] for s in r["secrets"])
        for s in r["secrets"]:
            if s["order"] == 3:
                token = t[s["start"]:s["end"]]
                assert token == s["value"]
                code = lambda c: secrets.ALPHABET.find(c) + 1
                rate = sum(ratio[code(a) * secrets.STATES + code(b)] for a, b in zip(token, token[1:]))
                assert math.isclose(rate / (len(token) - 1), s["score"], rel_tol=1e-9)


def test_secret_model_tells_random_from_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratio = secrets.train(docs)
    probe = spark.createDataFrame([("x ghp7Kq2ZvX9bTn4Lw8RfYs3D y",), ("x internationalization-of-words y",)], "text string")
    random, plain = [r["secrets"] for r in secrets.scan(probe, ratio).collect()]
    assert [s["order"] for s in random] == [3] and plain == []


def test_redact(spark):
    docs = spark.createDataFrame([("a token = 'abcdefgh12' b",), ("plain",), (None,)], "text string")
    found = secrets.scan(docs, [0.0] * secrets.STATES**2)
    assert [r[0] for r in found.select(secrets.redact(F.col("text"), F.col("secrets"))).collect()] == ["a [SECRET]' b", "plain", None]


def test_token_around_a_known_span_is_scored(spark):
    secret = "live-0123456789abcdef01234567-Kq2ZvX9bTn4Lw8RfYs3DKq2ZvX9bTn4Lw8RfYs3D"
    docs = spark.createDataFrame([(f"a {secret} b token=abcdefgh12abcdefgh12 c",)], "text string")
    found = secrets.scan(docs, [1.0] * secrets.STATES**2)
    (row,) = found.select("secrets", secrets.redact(F.col("text"), F.col("secrets")).alias("clean")).collect()
    assert [s["order"] for s in row["secrets"]] == [3, 2, 0] and row["clean"] == "a [SECRET] b [SECRET] c"


def plain_redact(text, spans):
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 200])
def test_before(spark, n):
    values = [(i * 37) % 11 for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    sums, tops = df.select(before(F.col("v"), F.lit(0), lambda a, x: a + x), before(F.col("v"), F.lit(0), lambda a, x: F.greatest(a, x))).first()
    assert sums == [sum(values[:i]) for i in range(n)] and tops == [max(values[:i], default=0) for i in range(n)]


@pytest.fixture(scope="module")
def learned(spark):
    return secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_secrets_without_a_known_shape(spark, learned):
    """Half of the rows hold a random token, half an ordinary identifier; neither was seen in training."""
    assert learned.recall > 0.95 and learned.false_rate <= secrets.FALSE_RATE and learned.least > 0
    rng = random.Random(5)
    words = [w for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(300).collect() for w in re.findall("[a-z]{3,12}", r["text"] or "")]
    alphabets = [secrets.ALPHABET[:62], secrets.ALPHABET[26:36] + secrets.ALPHABET[52:62], "0123456789ABCDEF", secrets.ALPHABET[:26] + "0123456789"]
    rows = []
    for i in range(400):
        rows.append((f"é {''.join(rng.choice(alphabets[i % 4]) for _ in range(rng.randint(20, 60)))} of", True))
        rows.append((f"the {rng.choice('_-').join(rng.sample(words, 5))} of", False))
    got = secrets.scan(spark.createDataFrame(rows, "text string, secret boolean"), learned).select("secret", "text", "secrets").collect()
    hit = [r["secret"] for r in got if any(s["order"] == 3 for s in r["secrets"])]
    assert hit.count(True) >= 0.97 * 400 and hit.count(False) <= 2
    for r in got:
        assert all(r["text"][s["start"]:s["end"]] == s["value"] for s in r["secrets"])


def test_rulers_and_repeats_are_no_secrets(spark, learned):
    docs = spark.createDataFrame([("-" * 40,), ("=-" * 30,), ("x" * 5000,), ("_" * 16 + "=" * 16,)], "text string")
    assert all(r["secrets"] == [] for r in secrets.scan(docs, learned).collect())


def test_without_words_no_token_passes(spark):
    docs = spark.createDataFrame([("Kq2ZvX9bTn4Lw8RfYs3D token=abcdefgh12",)], "text string").where("text like 'K%'")
    alone = spark.createDataFrame([("Kq2ZvX9bTn4Lw8RfYs3D",), (None,)], "text string")
    assert secrets.train(alone).least == math.inf
    assert [s["order"] for s in secrets.scan(docs, secrets.train(alone)).first()["secrets"]] == [0]


def test_very_long_texts_take_linear_time(spark, learned):
    rng = random.Random(3)
    token = "".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(1_000_000))
    matches = "".join(f"é token=abc{i:06d} " for i in range(100_000))
    docs = spark.createDataFrame([(1, token), (2, matches)], "id int, text string")
    t0 = time.perf_counter()
    found = secrets.scan(docs, learned)
    rows = {r["id"]: r for r in found.select("id", "secrets", secrets.redact(F.col("text"), F.col("secrets")).alias("clean")).collect()}
    assert time.perf_counter() - t0 < 60
    assert [(s["start"], s["end"]) for s in rows[1]["secrets"]] == [(0, 1_000_000)] and rows[1]["clean"] == "[SECRET]"
    spans = [(s["start"], s["end"]) for s in rows[2]["secrets"]]
    assert spans == [m.span() for m in re.finditer(r"token=\w+", matches)]
    assert rows[2]["clean"] == plain_redact(matches, spans)


def test_redact_overlaps(spark):
    spans = [(0, 3), (2, 5), (2, 3), (5, 6), (9, 12), (9, 10), (20, 22)]
    text = "aé😀defghijklmnopqrstuv"
    df = spark.createDataFrame([(text, [{"start": a, "end": b} for a, b in spans]), (text, []), ("", [])], "t string, s array<struct<start:int,end:int>>")
    assert [r[0] for r in df.select(secrets.redact(F.col("t"), F.col("s"))).collect()] == [plain_redact(text, spans), text, ""]


def plain_counts(text):
    t = text or ""
    words = plain_words(t)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if plain_words(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(texts):
    rows = quality.judge(texts).collect()
    assert len(rows) == texts.count()
    for r in rows:
        want = plain_counts(r["text"])
        got = [x for x in r if hasattr(x, "n_words")][0]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_quality_keeps_good_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").dropDuplicates(["doc_id"])
    rates = dict(quality.judge(docs).where("m.n_words >= 50").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect())
    assert rates[1] > 0.99 and rates[0] < 0.3, rates


def test_buckets_hold_their_numbers(spark):
    v = F.col("id")
    rows = spark.range(5000).select(v, quality.bucket(v).alias("b"), quality.bucket_top(quality.bucket(v)).alias("top")).collect()
    for a, b in zip(rows, rows[1:]):
        assert a["b"] <= b["b"] and a["top"] >= a["id"] and a["top"] <= a["id"] * 17 / 16
        assert (a["b"] == b["b"]) == (a["top"] >= b["id"])


def plain_targets(sizes):
    order = sorted(k for k in sizes if k is not None) + ([None] if None in sizes else [])
    weight = {k: mixing.WEIGHTS[i % 3] for i, k in enumerate(order)}
    target, left, free = dict.fromkeys(sizes, 0.0), 1.5 * sum(sizes.values()), set(sizes)
    while free and left > 1e-9:
        unit = left / sum(weight[k] for k in free)
        full = {k for k in free if target[k] + unit * weight[k] >= 2 * sizes[k] - 1e-9}
        for k in free:
            add = min(unit * weight[k], 2 * sizes[k] - target[k])
            target[k] += add
            left -= add
        if not full:
            break
        free -= full
    return target


def test_mixing(texts):
    rows = mixing.mix(texts).collect()
    assert len(rows) == texts.count()
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in rows:
        x = r["mix"]
        assert x["size"] == len(plain_words(r["text"])) and 0 <= x["copies"] <= 2
        sizes[r["source"]] += x["size"]
        taken[r["source"]] += x["size"] * x["copies"]
        longest[r["source"]] = max(longest[r["source"]], x["size"])
    want = plain_targets(sizes)
    for r in rows:
        assert r["mix"]["source_size"] == sizes[r["source"]]
        assert math.isclose(r["mix"]["target"], want[r["source"]], rel_tol=1e-9)
    for k, n in taken.items():
        assert abs(n - want[k]) <= longest[k] / 2 + 1e-6
    again = mixing.mix(texts.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_targets_of_many_sources(spark, coalesce):
    """Sources over several ranges, ties in the ratio of size and weight, sources without words, a missing one."""
    sizes = {f"s{i:03d}": (i * i * 7919) % 5000 * (i % 11 > 0) for i in range(400)} | {None: 1234, "": 10, "Ä": 99}
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        rows = spark.createDataFrame([("-" if k is None else "=" + k, n) for k, n in sizes.items()], "key string, size long")
        got = {r["key"]: (r["source_size"], r["target"]) for r in mixing.targets(rows.repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    want = plain_targets(sizes)
    assert len(got) == len(sizes)
    for k, n in sizes.items():
        size, target = got["-" if k is None else "=" + k]
        assert size == n and math.isclose(target, want[k], rel_tol=1e-9, abs_tol=1e-9)


def test_names_with_dots(texts):
    plain = texts.select("doc_id", "text", "lang", "source")
    dotted = plain.toDF("a.id", "a.text", "a.lang", "a.source")
    names = {"text": "a.text", "source": "a.source"}
    as_rows = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert as_rows(mixing.mix(dotted, doc_id="a.id", **names)) == as_rows(mixing.mix(plain))
    assert as_rows(mixing.mix_slim(dotted, doc_id="a.id", **names)) == as_rows(mixing.mix_slim(plain))
    assert as_rows(quality.judge(dotted, lang="a.lang", **names)) == as_rows(quality.judge(plain))
    some = quality.judge(dotted, lang="a.lang", carry=["a.lang", "a.source"], **names)
    assert some.columns[:2] == ["a.lang", "a.source"]


@pytest.mark.parametrize("name", sorted(set(queries.queries()) & {"op1_license_scan", "op5_secret_scan", "op9_quality_rules", "op10_mix_sources"}))
def test_empty_table(spark, tmp_path, name):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.queries()[name](spark, str(tmp_path)).collect() == []


def test_digest(spark):
    for r in queries.op5_secret_scan(spark, SF).collect():
        base = ",".join(x for x in r["spans"].split(",") if x and not x.startswith("markov"))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
