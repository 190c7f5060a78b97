"""Cheapest repair of the order of roles in conversations: auction shortest paths over the lattice of edits.

A point of the lattice is (rows consumed, state of the pattern ``(s?(ua)+)?``). Edits are its arcs, with whole costs: keep a
row, give it another role, delete it, insert an empty turn. The auction holds a price per point and a path from the start:
where no arc is tight at the path's end, the end's price rises to its cheapest arc and the path contracts, otherwise it
extends along that arc. When it reaches the goal, every cheapest path runs over tight arcs only, and the least one by the
letters of its edits is traced along them.

A conversation is cut into segments of at most ``SEGMENT`` rows. The auction runs once per segment and state for the
distances between states, a stream over the segments carries the costs to the end backwards, the auction runs again with
these as prices of the exits, and a second stream picks each segment's entry state. Conversations of one segment need one run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import SPACES
from .ordered import laid, streamed

SEGMENT = 64
# Costs of the edits, and the states after nothing, a system, a user, an assistant turn.
RETAIN, RENAME, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60
ENDING = (0, FAR, FAR, 0)
STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


# --- one segment -------------------------------------------------------------------------------------------------------

def _after_keep(initial: str, state: int) -> int | None:
    """State after a kept row, if the pattern allows it there."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def lattice(codes: str, exits: tuple[int, ...], last: bool) -> list[list[tuple[str, int, int]]]:
    """Arcs (letter, target, cost) of every point, 4 * rows consumed + state; the goal is the last point.

    A code is the initial of a row's role (``x``: another), in upper case if the row is truncated, or ``d`` if it must go.
    ``exits`` are the costs from each state after the last row to the goal. Turns may be inserted after the last row only
    in the ``last`` segment; elsewhere they belong to the next one.
    """
    n = len(codes)
    goal = 4 * (n + 1)
    out: list[list[tuple[str, int, int]]] = []
    for i in range(n + 1):
        code = codes[i] if i < n else ""
        extra = TRUNCATED if code.isupper() else 0
        for q in range(4):
            arcs = []
            partner = ASSISTANT if q == USER else USER
            if i < n:
                arcs.append(("D", 4 * (i + 1) + q, DELETE))
                if code != "d":
                    kept = _after_keep(code.lower(), q)
                    if kept is not None:
                        arcs.append(("K", 4 * (i + 1) + kept, RETAIN + extra))
                    arcs.append(("R", 4 * (i + 1) + partner, RENAME + extra))
            elif exits[q] < FAR:
                arcs.append(("", goal, exits[q]))
            if i < n or last:
                arcs.append(("I", 4 * i + partner, INSERT))
            out.append(arcs)
    out.append([])
    # Without a way to the goal, prices would rise for ever: only arcs to points that have one stay.
    back: dict[int, list[int]] = {}
    for v, arcs in enumerate(out):
        for _, target, _ in arcs:
            back.setdefault(target, []).append(v)
    open_, seen = [goal], {goal}
    while open_:
        for v in back.get(open_.pop(), ()):
            if v not in seen:
                seen.add(v)
                open_.append(v)
    return [[a for a in arcs if a[1] in seen] for arcs in out]


def first_prices(codes: str, exits: tuple[int, ...]) -> list[int]:
    """Prices that no arc undercuts: what each remaining row costs at least, plus the cheapest exit."""
    rest = min(exits)
    prices = [0]
    for code in ["", *reversed(codes)]:
        rest += DELETE if code == "d" else TRUNCATED if code.isupper() else 0
        prices[:0] = [rest] * 4
    return prices


def auction(arcs: list, prices: list[int], start: int) -> int:
    """Distance from ``start`` to the last point; raises ``prices``, which stay valid for further starts."""
    goal = len(arcs) - 1
    path = [start]
    while path[-1] != goal:
        at = path[-1]
        if not arcs[at]:
            return FAR
        best, to = FAR, -1
        for _, target, cost in arcs[at]:
            if cost + prices[target] < best:
                best, to = cost + prices[target], target
        if prices[at] < best:
            prices[at] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)
    return prices[start]


def trace(arcs: list, prices: list[int], start: int) -> tuple[str, int]:
    """Letters of the least cheapest path over tight arcs, and the point it leaves for the goal."""
    goal = len(arcs) - 1
    tight = lambda v: iter(sorted(a for a in arcs[v] if prices[v] == a[2] + prices[a[1]]))
    letters, points, left = [], [start], [tight(start)]
    dead: set[int] = set()
    while points[-1] != goal:
        arc = next(left[-1], None)
        if arc is None:
            dead.add(points.pop())
            left.pop()
            letters.pop()
        elif arc[1] not in dead:
            letters.append(arc[0])
            points.append(arc[1])
            left.append(tight(arc[1]))
    return "".join(letters), points[-2]


@lru_cache(maxsize=1 << 14)
def edits(codes: str, exits: tuple[int, ...], last: bool, starts: tuple[int, ...]) -> list[tuple[str, int, int] | None]:
    """(letters, exit state, cost inside) of the cheapest way from each start state, least letters first; None: no way."""
    arcs, prices = lattice(codes, exits, last), first_prices(codes, exits)
    out: list[tuple[str, int, int] | None] = []
    for q in starts:
        d = auction(arcs, prices, q)
        if d >= FAR:
            out.append(None)
            continue
        letters, point = trace(arcs, prices, q)
        out.append((letters, point - 4 * len(codes), d - exits[point - 4 * len(codes)]))
    return out


@lru_cache(maxsize=1 << 14)
def distances(codes: str, last: bool) -> list[int]:
    """Costs from each state to each state after the segment, row by row; of the last one, from each state to the end."""
    out = []
    for exits in [ENDING] if last else [tuple(0 if q == to else FAR for q in range(4)) for to in range(4)]:
        arcs, prices = lattice(codes, exits, last), first_prices(codes, exits)
        out.append([auction(arcs, prices, q) for q in range(4)])
    return [row[q] for q in range(4) for row in out]


# --- all segments ------------------------------------------------------------------------------------------------------

def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        d = [distances(c, n) for c, n in zip(b.column("codes").to_pylist(), b.column("last").to_pylist())]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d, pa.list_(pa.int64()))], names=[*b.schema.names, "costs"])


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs from the exits of every segment to the end of its conversation; segments arrive last first."""
    ahead = ENDING
    for b in batches:
        exits = []
        for last, costs in zip(b.column("last").to_pylist(), b.column("costs").to_pylist()):
            exits.append(list(ENDING if last else ahead))
            ahead = tuple(costs) if last else tuple(min(FAR, *(costs[4 * q + to] + ahead[to] for to in range(4))) for q in range(4))
        cols = [b.column(c) for c in ("g", "seg", "codes", "last")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(exits, pa.list_(pa.int64()))], names=["g", "seg", "codes", "last", "exits"])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of every segment for each entry state, as text: letters, exit state and cost."""
    for b in batches:
        out = []
        for codes, last, exits in zip(*(b.column(c).to_pylist() for c in ("codes", "last", "exits"))):
            found = edits(codes, tuple(exits), last, (0, 1, 2, 3))
            out.append([None if f is None else f"{f[0]} {f[1]} {f[2]}" for f in found])
        yield pa.RecordBatch.from_arrays([b.column("g"), b.column("seg"), pa.array(out, pa.list_(pa.string()))], names=["g", "seg", "ways"])


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits that hold, given the state each segment is entered in."""
    g, state = None, START
    for b in batches:
        rows = []
        for key, seg, ways in zip(*(b.column(c).to_pylist() for c in ("g", "seg", "ways"))):
            if key != g:
                g, state = key, START
            letters, to, cost = ways[state].split(" ")
            rows.append((key, seg, letters, state, int(cost)))
            state = int(to)
        yield _batch(rows, AUDIT)


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of conversations of one segment."""
    for b in batches:
        rows = []
        for key, seg, codes in zip(*(b.column(c).to_pylist() for c in ("g", "seg", "codes"))):
            letters, _, cost = edits(codes, ENDING, True, (START,))[0]
            rows.append((key, seg, letters, START, cost))
        yield _batch(rows, AUDIT)


AUDIT = pa.schema([("g", pa.string()), ("seg", pa.int64()), ("audit", pa.string()), ("entry", pa.int32()), ("cost", pa.int64())])
AUDIT_SQL = "g string, seg bigint, audit string, entry int, cost bigint"
REPAIRED = pa.schema([("g", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
REPAIRED_SQL = "g string, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


class _Conversation:
    """What the stream of one conversation's segments and rows amounts to."""

    def __init__(self, g: str):
        self.g, self.cost, self.illegal, self.before = g, 0, 0, None
        self.audits: list[str] = []
        self.sha, self.empty = hashlib.sha256(), True
        self.letters, self.at, self.state = "", 0, START

    def _turn(self, role: str, text: str) -> None:
        if not self.empty:
            self.sha.update(b"\n")
        self.empty = False
        self.sha.update(f"{role}:{text}".encode())

    def _new_role(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return "assistant" if self.state == ASSISTANT else "user"

    def _inserts(self) -> None:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self._turn(self._new_role(), "")
            self.at += 1

    def segment(self, audit: str, entry: int, cost: int) -> None:
        self._inserts()
        self.audits.append(audit)
        self.letters, self.at, self.state = audit, 0, entry
        self.cost += cost

    def row(self, role: str, text: str) -> None:
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self._inserts()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = STATE[initial]
            self._turn(role, text)
        elif letter == "R":
            self._turn(self._new_role(), text)

    def end(self) -> tuple:
        self._inserts()
        return self.g, self.illegal, self.cost, "".join(self.audits), self.sha.hexdigest()


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired conversations, hashed turn by turn; each segment's edits arrive before its rows."""
    here: _Conversation | None = None
    for b in batches:
        done = []
        for g, kind, role, text, entry, cost in zip(*(b.column(c).to_pylist() for c in ("g", "kind", "role", "text", "entry", "cost"))):
            if here is None or here.g != g:
                if here is not None:
                    done.append(here.end())
                here = _Conversation(g)
            if kind == 0:
                here.segment(text, entry, cost)
            else:
                here.row(role, text)
        yield _batch(done, REPAIRED)
    if here is not None:
        yield _batch([here.end()], REPAIRED)


def group_key(conv: str = "conv_id") -> Column:
    """The conversation as text, a missing id too."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("-"))


def repair(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation that has rows: g, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` is (g, turn, role, text, tie): g the conversation, rows ordered by turn (missing first) and tie; missing
    roles and texts are empty. Blank, repeated and truncated rows are counted by their first fault; gaps are missing turn
    numbers; illegal counts neighbours whose roles may not follow each other. Letters of the audit: Keep, Rerole, Delete,
    Insert. Other columns are ignored; no rows give none. The answer does not depend on ``segment``.

    A conversation's segments are solved side by side; what runs through a whole conversation in one stream is four costs a
    segment, the choice of states, and the hash of its turns, which has no parallel form.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    end = F.substring(F.rtrim(F.translate(text, SPACES[1:], " " * len(SPACES[1:]))), -1, 1)
    rows = turns.select("g", "turn", role.alias("role"), text.alias("text"), "tie").withColumns({
        "same": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")), "last": end})
    rows = laid(rows, "g", "turn", "tie").withColumn("seg", F.floor(F.col("at") / segment))

    first = rows.groupBy("g", "same").agg(F.min("at").alias("at")).withColumn("first", F.lit(True))
    initial = F.when(F.substring("role", 1, 1).isin(*STATE), F.substring("role", 1, 1)).otherwise("x")
    fault = (F.when(F.col("last") == "", "blank").when(F.col("first").isNull(), "duplicate")
             .when(~F.col("last").isin(".", "!", "?"), "truncated"))
    marked = rows.select("g", "at", "seg", "turn", "role", "same", "last").join(first, ["g", "same", "at"], "left").select(
        "g", "at", "seg", "turn", fault.alias("fault"), initial.alias("initial"))
    code = F.when(F.col("fault") == "truncated", F.upper("initial")).when(F.col("fault").isNotNull(), "d").otherwise(F.col("initial"))
    marked = cut_lineage(marked.select("g", "at", "seg", "turn", "fault", code.alias("code")))

    counts = marked.groupBy("g").agg(*[F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")])
    span = marked.groupBy("g", "turn").agg(F.lit(1).alias("one")).groupBy("g").agg(
        F.max("turn").cast("decimal(38,0)").alias("hi"), F.min("turn").cast("decimal(38,0)").alias("lo"), F.count("turn").alias("n"))
    gaps = span.select("g", F.coalesce(F.expr("try_cast(hi - lo + 1 - n as bigint)"), F.lit(0)).alias("gaps"))

    pieces = marked.groupBy("g", "seg").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]), "").alias("codes"))
    ends = marked.groupBy("g").agg(F.min("seg").alias("low"), F.max("seg").alias("high"))
    pieces = cut_lineage(pieces.join(ends, "g").withColumn("last", F.col("seg") == F.col("high")))
    alone = pieces.where("low = high").select("g", "seg", "codes").mapInArrow(_alone, AUDIT_SQL)
    many = pieces.where("low < high").select("g", "seg", "codes", "last")
    costs = many.mapInArrow(_measure, "g string, seg bigint, codes string, last boolean, costs array<bigint>")
    exits = cut_lineage(streamed(costs, ["g"], [F.desc("seg")], _backwards,
                                 "g string, seg bigint, codes string, last boolean, exits array<bigint>"))
    ways = exits.repartition("g", "seg").mapInArrow(_solve, "g string, seg bigint, ways array<string>")
    audits = alone.unionByName(streamed(ways, ["g"], ["seg"], _forwards, AUDIT_SQL))

    steps = audits.select("g", "seg", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), F.lit("").alias("role"),
                          F.col("audit").alias("text"), "entry", "cost")
    steps = steps.unionByName(rows.select("g", "seg", F.lit(1).alias("kind"), "at", "role", "text", F.lit(0).alias("entry"),
                                          F.lit(0).cast("long").alias("cost")))
    whole = streamed(steps, ["g"], ["seg", "kind", "at"], _assemble, REPAIRED_SQL)
    return whole.join(counts, "g").join(gaps, "g")


def damage(turns: DataFrame) -> DataFrame:
    """(g, turn, role, text, tie): rows dropped, emptied, cut short, repeated or given to the user by a check sum of their place.

    Missing roles and texts become empty; rows of the same turn are ordered by role and text, a repeat after its original.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    hit = (F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20).cast("int")
    rows = turns.select(group_key().alias("g"), "turn", role.alias("role"), text.alias("text"), hit.alias("hit")).where("hit <> 0")
    tie = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = rows.withColumn("tie", tie).withColumn("copy", F.explode(F.when(F.col("hit") == 3, F.array(F.lit("0"), F.lit("1"))).otherwise(F.array(F.lit("0")))))
    return rows.select(
        "g", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.concat("tie", "copy").alias("tie"))
