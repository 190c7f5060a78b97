"""Secret scans with character Markov models.

Known shapes (assignments, access keys, hex digests) are found by pattern. Two first-order Markov models of characters
are trained on labelled samples: random strings are drawn by a seeded hash in the usual alphabets (base64, its URL form,
letters and digits in both, lower or upper case, hex), ordinary identifiers are the words of the corpus, joined by
underscore and hyphen, in camel case and with a number behind. A quarter of both samples is held out. On it the threshold
is fitted: the least mean log-likelihood ratio that no more than FALSE_RATE of the ordinary identifiers reach, all cut to
the least length, where the two are hardest to tell apart. A long token that reaches it is a span as well.

Words are counted before they are taken apart, so the counts cost one row per distinct word and task, and what reaches the
driver is one number per pair of characters and one per step of the ratio, whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.vec import let
from ..session import cut_lineage
from .common import before, fresh, text_of

# The base patterns, the least length of what each must match, and their order.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 6, "access": 20, "hex": 24}

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(ALPHABET) + 1  # the last one (0) is any other character
WORD = r"[A-Za-z0-9+/_=-]{4,}"
LEAST_TOKEN = 16
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_TOKEN
LEAST_DISTINCT = 6    # rulers and repeated characters are no secrets
SMOOTHING = 0.5
LEAST_RATE = 0.6      # nats per transition, where no threshold was fitted
RANDOM_SAMPLE = 20_000  # strings drawn for the random class
FALSE_RATE = 1e-4     # share of held-out ordinary identifiers that may pass
STEPS = 100           # steps of the threshold per nat
_SPAN = "struct<start:int,order:int,end:int,value:string>"


class Ratios(list):
    """Log-likelihood ratio (random against ordinary) per pair of characters, with the fitted threshold (`least`, nats per
    transition) and the shares of held-out random strings (`recall`) and ordinary identifiers (`false_rate`) that reach it."""

    def __init__(self, values: Iterable[float], least: float = LEAST_RATE, recall: float | None = None, false_rate: float | None = None):
        super().__init__(values)
        self.least, self.recall, self.false_rate = least, recall, false_rate


def _spans(t: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """Spans of all matches whose `group` is long enough, in code points, by adding up what lies between them."""
    found = F.arrays_zip(
        F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("m"), F.regexp_extract_all(t, F.lit(pattern), F.lit(group)).alias("g"),
        F.split(t, pattern).alias("gap"))

    def placed(z: Column) -> Column:
        length = lambda x: F.coalesce(F.length(x), F.lit(0))
        starts = before(F.transform(z, lambda x: length(x["gap"]) + length(x["m"])), F.lit(0), lambda a, x: a + x)

        def span(x: Column, start: Column) -> Column:
            start = start + length(x["gap"])
            return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("order"), (start + length(x["m"])).alias("end"), x["g"].alias("value"))

        return F.filter(F.zip_with(z, starts, span), lambda x: F.length(x["value"]) >= least)

    return let(found, placed)


def _none() -> Column:
    return F.expr(f"cast(array() as array<{_SPAN}>)")


def base_spans(t: Column) -> Column:
    """Spans of the known shapes; each pattern is gated by a cheap test for the whole text."""
    gates = (("assign", ASSIGN, 2, "(?i)passw|secret|token|api_?key"), ("access", ACCESS, 0, "AKIA[A-Z0-9]{16}"), ("hex", HEX, 0, "[0-9a-f]{24}"))
    return F.concat(*[F.when(t.rlike(gate), _spans(t, pattern, group, LEAST[kind], kind)).otherwise(_none()) for kind, pattern, group, gate in gates])


def _numbers(values: Iterable, kind: str) -> Column:
    """A constant array, written as text that Spark folds once."""
    return F.expr("cast(split('" + ",".join(map(str, values)) + f"', ',') as array<{kind}>)")


def _pairs(token: Column) -> Column:
    """Per two adjacent characters of a token their state: first * STATES + second; linear in its length."""
    place = _numbers([ALPHABET.find(chr(i)) + 1 for i in range(128)], "int")
    codes = F.transform(F.split(token, ""), lambda c: F.coalesce(F.get(place, F.ascii(c)), F.lit(0)))
    return let(codes, lambda k: F.zip_with(
        F.slice(k, F.lit(1), F.size(k) - 1), F.slice(k, F.lit(2), F.size(k) - 1), lambda a, b: a * STATES + b))


def _rate(token: Column, ratio: list[float]) -> Column:
    """Mean log-likelihood ratio per transition."""
    table = _numbers(map(repr, ratio), "double")
    return F.aggregate(_pairs(token), F.lit(0.0), lambda a, p: a + F.get(table, p)) / (F.length(token) - 1)


def random_strings(docs: DataFrame) -> DataFrame:
    """(word, n, held) of the random class: RANDOM_SAMPLE strings of 40 characters, the same on every run."""
    digest = F.sha2(F.concat(F.lit("random string "), F.col("id").cast("string")), 512)
    b64 = F.base64(F.unhex(digest))
    plain = F.translate(b64, "+/=", "")
    styles = (b64, F.translate(b64, "+/", "-_"), plain, F.lower(plain), F.upper(plain), digest, F.upper(digest))
    word = F.substring(F.get(F.array(*styles), F.col("id") % len(styles)), 1, 40)
    return docs.sparkSession.range(RANDOM_SAMPLE).select(word.alias("word"), F.lit(1).cast("long").alias("n"), (F.pmod(F.xxhash64("id"), F.lit(4)) == 3).alias("held"))


def identifiers(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n, held) of the ordinary class: each shorter word of the corpus as a long identifier, with its number of places."""
    words = docs.select(F.explode(F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))).alias("w")).where(F.length("w") < LEAST_TOKEN)
    words = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    number = F.pmod(F.xxhash64("w"), F.lit(10_000)).cast("string")
    word = F.concat("w", F.lit("_"), "w", F.lit("-"), "w", F.initcap("w"), number)
    return words.select(word.alias("word"), "n", (F.pmod(F.xxhash64("w"), F.lit(4)) == 3).alias("held"))


def train(docs: DataFrame, text: str = "text") -> Ratios:
    """The two models and the threshold, from every text of the frame and RANDOM_SAMPLE random strings.

    Without words to learn ordinary identifiers from, no threshold can be fitted and no token reaches it.
    """
    both = cut_lineage(identifiers(docs, text).withColumn("kind", F.lit(0)).unionByName(random_strings(docs).withColumn("kind", F.lit(1))))
    states = both.where(~F.col("held")).select("kind", "n", F.explode(_pairs(F.col("word"))).alias("state"))
    counts = [[0.0] * (STATES * STATES) for _ in range(2)]
    for kind, state, n in states.groupBy("kind", "state").agg(F.sum("n")).collect():  # at most 2 * STATES^2 rows
        counts[kind][state] = float(n)
    tables = []
    for c in counts:
        table = []
        for a in range(STATES):
            row = [x + SMOOTHING for x in c[a * STATES:(a + 1) * STATES]]
            total = sum(row)
            table += [math.log(x / total) for x in row]
        tables.append(table)
    ratio = [round(r - o, 6) for r, o in zip(tables[1], tables[0], strict=True)]
    step = F.floor(_rate(F.substring("word", 1, LEAST_TOKEN), ratio) * STEPS).cast("long")
    held = [{}, {}]
    for kind, at, n in both.where("held").groupBy("kind", step.alias("at")).agg(F.sum("n")).collect():  # the ratio has at most 40 * STEPS steps
        held[kind][at] = n
    if not held[0]:
        return Ratios(ratio, math.inf)
    share = lambda kind, least: sum(n for at, n in held[kind].items() if at >= least) / sum(held[kind].values())
    least = next(at for at in range(max(0, min(held[0])), max(0, max(held[0])) + 2) if share(0, at) <= FALSE_RATE)
    return Ratios(ratio, least / STEPS, share(1, least), share(0, least))


def scan(docs: DataFrame, ratio: Ratios | list[float], text: str = "text") -> DataFrame:
    """The frame with a column `secrets`: array of (start, order, end, value, score), by start, then kind.

    `order` numbers KINDS; start and end are code points, end exclusive; the score is the mean log-likelihood ratio per
    transition (null for known shapes). Tokens that one known span covers whole are not scored again. Missing and empty texts
    have no spans; repeated rows stay repeated.
    """
    t, out = fresh(docs, "t_", "secrets")
    least = getattr(ratio, "least", LEAST_RATE)
    tokens = F.when(F.col(t).rlike(TOKEN), _spans(F.col(t), TOKEN, 0, LEAST_TOKEN, "markov")).otherwise(_none())

    def score(x: Column) -> Column:
        rated = F.when((x["order"] == 3) & (F.size(F.array_distinct(F.split(x["value"], ""))) >= LEAST_DISTINCT), _rate(x["value"], ratio))
        return F.struct(*[x[f].alias(f) for f in ("start", "order", "end", "value")], rated.alias("score"))

    def open_ones(all_: Column) -> Column:
        """Without tokens that end within a known span that starts no later; those stand before them."""
        reach = before(F.transform(all_, lambda x: F.when(x["order"] < 3, x["end"]).otherwise(F.lit(0))), F.lit(0), lambda a, x: F.greatest(a, x))
        kept = F.filter(F.zip_with(all_, reach, lambda x, r: F.struct(x.alias("x"), r.alias("r"))), lambda y: (y["x"]["order"] < 3) | (y["r"] < y["x"]["end"]))
        return F.transform(kept, lambda y: score(y["x"]))

    found = let(F.array_sort(F.concat(base_spans(F.col(t)), tokens)), open_ones)
    found = F.filter(found, lambda x: (x["order"] < 3) | (x["score"] >= F.lit(float(least))))
    return docs.withColumn(t, text_of(text)).withColumn(out, found).select(*docs.columns, out)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones once, replaced by a mark; linear in its length."""
    reach = lambda s: before(F.transform(s, lambda x: x["end"]), F.lit(0), lambda a, x: F.greatest(a, x))

    def clean(chars: Column) -> Column:
        part = lambda start, n: F.array_join(F.slice(chars, start + 1, n), "")
        pieces = F.zip_with(spans, reach(spans), lambda x, r: F.when(
            x["start"] >= r, F.concat(part(r, x["start"] - r), F.lit(mark))).otherwise(F.lit("")))
        end = F.array_max(F.transform(spans, lambda x: x["end"]))
        return F.concat(F.array_join(pieces, ""), part(end, F.greatest(F.size(chars) - end, F.lit(0))))

    return F.when(F.size(spans) > 0, let(F.split(text, ""), clean)).otherwise(text)
