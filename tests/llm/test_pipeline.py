"""Every pipeline stage on its own input against plain Python, and the stages in a row."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_free import plain_classes, words_of
from test_native import plain_counts, plain_targets, plain_words

import corpus_pipeline
from motionweave.llm import secrets

SF = "/root/testdata/sf0.001"
ROWS = [(None, "no id but words " * 20, None, None), (5, None, "en", "src1"), (5, None, "en", "src1"), (6, "", None, "src0"),
        (7, "token = 'abcdefgh12345678' and " + " ".join(f"w{i}" for i in range(90)), "en", None),
        (8, "token = 'abcdefgh12345678' and " + " ".join(f"w{i}" for i in range(90)), "en", None)]


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in ROWS], own.schema)
    return own.unionByName(odd).withColumn("key", F.lit(1)).withColumn("copy", F.lit("clash")).withColumn("bucket", F.lit(2))


@pytest.fixture(scope="module")
def steps(spark, docs, tmp_path_factory):
    out, at = [docs], docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, at, SF).write.parquet(path)
        at = spark.read.parquet(path)
        out.append(at)
    return out


def rows(df):
    return Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())


def test_stages_keep_the_columns(steps, docs):
    for df in steps[1:-1]:
        assert df.columns == docs.columns
    assert len(corpus_pipeline.STAGES) == 5


def test_quality_stage(steps):
    before, after = rows(steps[0]), rows(steps[1])
    assert after <= before
    for (_, text, _), n in after.items():
        words, *_, repeated = plain_counts(text)
        assert words >= 50 and 100 * repeated <= 50 * words
    whole = sum(n for (_, t, _), n in before.items() if plain_counts(t)[0] >= 50 and 100 * plain_counts(t)[4] <= 50 * plain_counts(t)[0])
    assert sum(after.values()) >= 0.85 * whole


def test_near_duplicate_stage(steps):
    before = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    want = Counter((i, t) for (i, t), (_, c) in zip(before, plain_classes(before), strict=True) if i == c or not words_of(t))
    assert Counter((r["doc_id"], r["text"]) for r in steps[2].collect()) == want


def test_secret_stage(steps):
    before = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    after = {r["doc_id"]: r for r in steps[3].collect()}
    assert before.keys() == after.keys()
    hidden = 0
    for k, row in after.items():
        assert row["n_chars"] == len(row["text"])
        assert not re.search("[0-9a-f]{24}|AKIA[A-Z0-9]{16}", row["text"])
        if "[SECRET]" in row["text"]:
            hidden += 1
        else:
            assert row["text"] == before[k]
    assert hidden


def test_mixing_stage(steps):
    size, taken = Counter(), Counter()
    longest = Counter()
    before, after = rows(steps[3]), rows(steps[4])
    for (_, t, s), n in before.items():
        size[s] += n * len(plain_words(t))
        longest[s] = max(longest[s], len(plain_words(t)))
    for k, n in after.items():
        assert n <= 2 * before[k]
        taken[k[2]] += n * len(plain_words(k[1]))
    for s, want in plain_targets(size).items():
        assert abs(taken[s] - want) <= longest[s] / 2 + 1e-6


def test_packing_stage(steps):
    pieces, total = defaultdict(list), Counter()
    for r in steps[5].collect():
        pieces[r["sequence_id"]].append((r["offset"], r["length"]))
        total[r["doc_id"], r["doc_tokens"]] += r["length"]
    for parts in pieces.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    copies = Counter(r["doc_id"] for r in steps[4].collect())
    by_id = defaultdict(int)
    for (ident, tokens), n in total.items():
        assert n % tokens == 0
        by_id[ident] += n // tokens
    assert by_id == copies


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_empty_documents(spark, docs, tmp_path):
    at = docs.limit(0)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, SF).write.parquet(f"{tmp_path}/{i}")
        at = spark.read.parquet(f"{tmp_path}/{i}")
        assert at.count() == 0
    assert secrets.KINDS[3] == "markov"
