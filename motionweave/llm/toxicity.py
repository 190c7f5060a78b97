"""Toxic passages by maximal scoring segments over token log-odds.

Every word, and every beginning of a word (4 to 7 bytes, which stands for its stem), has the log-odds of being written
in a toxic rather than a clean text. Both rates have a Dirichlet prior that is the rate in the whole corpus, so what no
label has seen is neutral. Log-odds that their own variance explains are damped; a word scores what its surest form
says. A small cost per word makes a text without toxic words drift downwards. The passages of a text are its maximal
scoring segments (those that no neighbour improves), found in one pass.

The best segment of n words without toxic intent follows an extreme-value law, P(score >= x) = 1 - exp(-K n e^(-lambda x)).
lambda solves the corpus equation sum p e^(lambda s) = 1 over word rates p, K is the maximum-likelihood value over clean
texts. Passages with an expected count E = K n e^(-lambda s) below SIGNIFICANT are reported; a text's score is a
logistic function of the significance of the best passage and of all of them together, fitted on texts that the scored
model has not seen (three folds).

Words are hashed to 2^BITS slots, so the model has one size whatever the corpus. Labels of at most LABELLED texts are
used (the first by a hash of their id); corpus rates count every word of every text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, quoted, text_of
from .textbytes import blocks, mix, offsets_and_bytes, word_hashes, word_starts

BITS = 20
STEMS = (4, 5, 6, 7)  # bytes
SLOTS = 1 << BITS
LABELLED = 60_000
FOLDS = 3
PRIOR = 2_000.0      # words that the prior weighs
DRIFT = 0.8          # cost of a word
SURE = 3.0           # standard errors below which log-odds are damped to nothing
SIGNIFICANT = 0.01
THRESHOLD = 0.3


@dataclass
class Model:
    odds: np.ndarray          # score per slot
    decay: float              # lambda
    scale: float              # K
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)


def _slots(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots, row): for each word the slots of its forms, the whole word first, a short word's own slot otherwise."""
    h, row, start, end = word_hashes(offsets, data)
    forms = [h] + [mix(word_starts(offsets, data, start, np.minimum(start + size, end)) + np.uint64(size)) for size in STEMS]
    return np.stack([(f >> np.uint64(64 - BITS)).astype(np.int64) for f in forms]), row


def _scores(odds: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Per word what the form with the largest absolute log-odds says, less the drift."""
    if slots.shape[1] == 0:
        return np.zeros(0)
    each = odds[slots]
    return np.take_along_axis(each, np.abs(each).argmax(axis=0)[None], axis=0)[0].astype(np.float64) - DRIFT


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a task: kind 0 is all texts, 1 + 2 * fold + label the labelled ones."""
    counts = np.zeros((1 + 2 * FOLDS, SLOTS), np.int64)
    for batch in batches:
        offsets, data = offsets_and_bytes(batch.column(0))
        kind = batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi in blocks(offsets):
            slot, row = _slots(offsets[lo:hi + 1], data)
            counts[0] += np.bincount(slot.ravel(), minlength=SLOTS)
            mine = kind[lo:hi][row]
            for k in np.unique(mine[mine > 0]):
                counts[k] += np.bincount(slot[:, mine == k].ravel(), minlength=SLOTS)
    k, s = np.nonzero(counts)
    if len(k):
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(s.astype(np.int32)), pa.array(counts[k, s])], names=["kind", "slot", "n"])


def log_odds(corpus: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Damped log-odds per slot under a Dirichlet prior with the corpus rates."""
    prior = PRIOR * (corpus + 0.1) / (corpus + 0.1).sum()
    total = lambda c: c.sum() + PRIOR
    t, c = toxic + prior, clean + prior
    delta = np.log(t / (total(toxic) - t)) - np.log(c / (total(clean) - c))
    sure = np.abs(delta) / np.sqrt(1 / t + 1 / c)
    return (delta * np.clip(sure / SURE - 1, 0, 1)).astype(np.float32)


def decay_of(odds: np.ndarray, corpus: np.ndarray) -> float:
    """lambda > 0 with sum p e^(lambda s) = 1, by bisection; the expected score is negative."""
    p = corpus / max(1, corpus.sum())
    f = lambda x: float(np.sum(p * np.exp(np.minimum(x * (odds - DRIFT), 50.0)))) - 1.0
    lo, hi = 1e-6, 1.0
    while f(hi) < 0 and hi < 1e3:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return max(hi, 1e-3)


def best_segments(score: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Best segment score of each of n texts (at least 0), from all words of a block at once."""
    best = np.zeros(n)
    if len(score) == 0:
        return best
    far = 2.0 * (np.abs(score).sum() + 1.0)
    total = np.cumsum(score.astype(np.float64)) - far * row
    before = np.r_[0.0, total[:-1]]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    before[first] = total[first] - score[first]
    gain = total - np.minimum.accumulate(before)
    best[row[first]] = np.maximum(np.maximum.reduceat(gain, first), 0.0)
    return best


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order, by one pass over the words that score above zero."""
    up = np.flatnonzero(score > 0)
    total = np.r_[0.0, np.cumsum(score.astype(np.float64))]
    stack: list[list[float]] = []  # start, end, sum before, sum after
    for i in up:
        here = [int(i), int(i) + 1, total[i], total[i + 1]]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= here[2]:
                j -= 1
            if j < 0 or stack[j][3] >= here[3]:
                stack.append(here)
                break
            here = [stack[j][0], here[1], stack[j][2], here[3]]
            del stack[j:]
    return [(int(a), int(b), y - x) for a, b, x, y in stack]


def _features(model: Model, slot: np.ndarray, row: np.ndarray, n: int, passages: bool):
    """(significance of the best passage, of all together) per text, and the passages."""
    score = _scores(model.odds, slot)
    best = best_segments(score, row, n)
    size = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    level = lambda s, words: model.decay * s - math.log(model.scale) - np.log(np.maximum(words, 1))
    top = np.where(best > 0, level(best, size), -10.0)
    both = np.maximum(top, 0.0)
    found: list[list[tuple[int, int, float, float]]] = [[] for _ in range(n)]
    at = np.searchsorted(row, np.arange(n + 1))
    for i in np.flatnonzero(top > 0):
        for a, b, s in segments(score[at[i]:at[i + 1]]):
            x = float(level(s, size[i]))
            if x > 0:
                both[i] += x if s < best[i] - 1e-9 else 0.0
            if passages and math.exp(-min(x, 700.0)) < SIGNIFICANT:
                found[i].append((a, b, s, math.exp(-min(x, 700.0))))
    return np.clip(top, -10.0, 60.0) / 10.0, np.log1p(both), found


def _probe(models: list[Model]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = offsets_and_bytes(batch.column(0))
            kind = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in blocks(offsets):
                slot, row = _slots(offsets[lo:hi + 1], data)
                n = hi - lo
                fold, label = (kind[lo:hi] - 1) // 2, (kind[lo:hi] - 1) % 2
                best, one, two = np.zeros(n), np.zeros(n), np.zeros(n)
                for k in range(FOLDS):
                    a, b, _ = _features(models[k], slot, row, n, False)
                    m = fold == k
                    best[m] = best_segments(_scores(models[k].odds, slot), row, n)[m]
                    one[m], two[m] = a[m], b[m]
                size = np.bincount(row, minlength=n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label.astype(np.int32)), pa.array(fold.astype(np.int32)), pa.array(size), pa.array(best), pa.array(one), pa.array(two)],
                    names=["label", "fold", "size", "best", "one", "two"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights (intercept first) by Newton steps with a little shrinkage."""
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (y - p) - 1e-3 * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic") -> Model:
    """Model from all texts of `docs` and the labels (ids with a 0/1 mark; several marks of an id count as the largest)."""
    marks = labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("mark_id")).agg(F.max(toxic).alias("mark"))
    order = F.xxhash64("mark_id", F.lit(11))
    marks = F.broadcast(marks.orderBy(order, "mark_id").limit(LABELLED).select(
        "mark_id", (1 + 2 * F.pmod(order, F.lit(FOLDS)) + F.when(F.col("mark") > 0, 1).otherwise(0)).cast("int").alias("kind")))
    rows = docs.select(F.col(quoted(doc_id)).alias("id"), text_of(text).alias("t")).join(marks, F.col("id") == F.col("mark_id"), "left").select(
        "t", F.coalesce("kind", F.lit(0)).alias("kind"))
    table = rows.mapInArrow(_counter, "kind int, slot int, n bigint").groupBy("kind", "slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((1 + 2 * FOLDS, SLOTS))  # the table has at most this many rows
    counts[table["kind"].to_numpy(), table["slot"].to_numpy()] = table["n"].to_numpy()
    clean, toxic_n = counts[1::2].sum(axis=0), counts[2::2].sum(axis=0)
    full = Model(log_odds(counts[0], clean, toxic_n), 1.0, 1.0)
    folds = [Model(log_odds(counts[0], clean - counts[1 + 2 * k], toxic_n - counts[2 + 2 * k]), 1.0, 1.0) for k in range(FOLDS)]
    for m in [full, *folds]:
        m.decay = decay_of(m.odds, counts[0])
    seen = rows.where("kind > 0")
    first = seen.mapInArrow(_probe(folds), "label int, fold int, size bigint, best double, one double, two double").toArrow()  # LABELLED rows
    get = lambda c: first[c].to_numpy()
    label, fold, size, best = get("label"), get("fold"), get("size"), get("best")
    for k, m in enumerate([*folds, full]):
        mine = (label == 0) & (size > 0) & ((fold == k) if k < FOLDS else np.ones(len(label), bool))
        if mine.any():
            m.scale = float(mine.sum() / max(1e-9, np.sum(size[mine] * np.exp(-m.decay * best[mine]))))
    again = seen.mapInArrow(_probe(folds), "label int, fold int, size bigint, best double, one double, two double").toArrow()
    x, y = np.c_[again["one"].to_numpy(), again["two"].to_numpy()], again["label"].to_numpy()
    if 0 < y.sum() < len(y):
        full.weights = _logistic(x, y)
    return full


def _scorer(model, carry: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            offsets, data = offsets_and_bytes(batch.column(carry))
            for lo, hi in blocks(offsets):
                slot, row = _slots(offsets[lo:hi + 1], data)
                one, two, found = _features(m, slot, row, hi - lo, True)
                score = 1 / (1 + np.exp(-np.clip(m.weights[0] + m.weights[1] * one + m.weights[2] * two, -30, 30)))
                passages = [[{"start": a, "end": b, "score": s, "expected": e} for a, b, s, e in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(lo, hi - lo) for k in range(carry)], pa.array(score), pa.array(passages, PASSAGES)],
                    names=[*batch.schema.names[:carry], "score", "passages"])
    return run


PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, passages) per row.

    `passages` are the significant maximal segments: word numbers (runs of letters, digits and characters beyond ASCII,
    end exclusive), score and expected count. Missing and empty texts get the score of a text without any toxic word.
    Repeated rows stay repeated; an empty table gives an empty frame.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS numbers
    (t,) = fresh(docs, "whole_text")
    rows = docs.select(F.col(quoted(doc_id)), text_of(text).alias(t))
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(_scorer(sent, 1), f"{quoted(doc_id)} {kind}, score double, "
                           "passages array<struct<start:int,end:int,score:double,expected:double>>")


def held_out(doc_id: Column) -> Column:
    """Ids whose CRC-32 leaves 2 by 4; never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
