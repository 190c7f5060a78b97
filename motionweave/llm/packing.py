"""Cost-balanced packing of tokenised documents into fixed-length training sequences.

A piece of n tokens costs n (linear layers) plus n^2 / SPAN (attention within the piece). Documents are taken by
descending length and each goes to the sequence with the least cost so far that still has room; what fits nowhere is cut
to fill the holes. A task works through its rows in buffers of about a million tokens, hands the rest of a buffer to the
next one, and ends with sequences whose lengths are powers of two, so that no padding is needed at all. Tokens never
leave the task that made them: there is no shuffle, and a lost task is packed again to the same sequences.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import fresh, quoted, text_of

CAPACITY = 2048
END = 1              # token that closes every document
SPAN = 4096          # tokens at which attention costs as much as the linear layers
BUFFER = 1 << 20     # tokens packed together
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# Texts that the merge table alone does not encode as the tokenizer file does, or only slowly.
_SPECIAL = re.compile(r"<\|endoftext\|>|\S{2000}|\s{2000}")


@lru_cache(maxsize=2)
def encoder(tokenizer: str, ranks: str):
    """text -> token ids of the tokenizer file, by its merge table where both agree."""
    import public_tokenizers as files
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(files.path(tokenizer))
    with open(files.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    quick = tiktoken.Encoding("merges", pat_str=files.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> list[int]:
        if _SPECIAL.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        return quick.encode_ordinary(text)

    return encode


class Piece:
    """Tokens of one document from `start` on; `row` names the document within its task."""

    __slots__ = ("row", "start", "ids")

    def __init__(self, row: int, start: int, ids: np.ndarray):
        self.row, self.start, self.ids = row, start, ids

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.row, self.start, self.ids[:n]), Piece(self.row, self.start + n, self.ids[n:])


def cost(n: int) -> float:
    return n + n * n / SPAN


def assign(pieces: list[Piece], capacity: int = CAPACITY) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences, and the pieces (fewer than `capacity` tokens) that are left over."""
    full, tails = [], []
    for p in pieces:
        while len(p.ids) >= capacity:
            head, p = p.cut(capacity)
            full.append([head])
        if len(p.ids):
            tails.append(p)
    n = sum(len(p.ids) for p in tails) // capacity
    if n == 0:
        return full, tails
    tails.sort(key=lambda p: (-len(p.ids), p.row, p.start))
    room = np.full(n, capacity)
    load = np.zeros(n)
    open_: list[list[Piece]] = [[] for _ in range(n)]
    rest = []
    for p in tails:
        size = len(p.ids)
        best = int(np.argmin(np.where(room >= size, load, np.inf)))
        if room[best] < size:
            rest.append(p)
            continue
        open_[best].append(p)
        room[best] -= size
        load[best] += cost(size)
    holes = [int(k) for k in np.argsort(-room, kind="stable") if room[k]]
    rest.reverse()  # the shortest is cut last
    for k in holes:
        while room[k]:
            p = rest.pop()
            if len(p.ids) > room[k]:
                p, more = p.cut(int(room[k]))
                rest.append(more)
            open_[k].append(p)
            room[k] -= len(p.ids)
    return full + open_, rest


def close(pieces: list[Piece]) -> list[list[Piece]]:
    """The last pieces of a task as sequences whose lengths are distinct powers of two."""
    left = sum(len(p.ids) for p in pieces)
    out, queue = [], list(reversed(pieces))
    for bit in reversed(range(left.bit_length())):
        size = 1 << bit
        if not left & size:
            continue
        row = []
        while size:
            p = queue.pop()
            if len(p.ids) > size:
                p, more = p.cut(size)
                queue.append(more)
            row.append(p)
            size -= len(p.ids)
        out.append(row)
    return out


def _packer(tokenizer: str, ranks: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks)
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 32
        held: list[Piece] = []
        names: dict[int, tuple] = {}   # row -> (id, tokens), as long as a piece of it is held
        row = size = sequence = 0

        def emit(packed: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            cols: list[list] = [[] for _ in range(8)]
            for pieces in packed:
                at = 0
                for p in pieces:
                    ident, total = names[p.row]
                    raw = p.ids.tobytes()
                    for c, v in zip(cols, (ident, p.start, len(p.ids), zlib.crc32(raw), total, base + sequence, at, p.ids if with_ids else None), strict=True):
                        c.append(v)
                    at += len(p.ids)
                sequence += 1
            kinds = [kind] + [pa.int64()] * 6 + [pa.list_(pa.int32())]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=NAMES)

        kind = pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                tokens = encode(texts[i].as_py())
                tokens.append(END)
                tokens = np.array(tokens, "<u4")
                names[row] = (ids[i].as_py(), len(tokens))
                held.append(Piece(row, 0, tokens))
                row += 1
                size += len(tokens)
                if size >= BUFFER:
                    done, held = assign(held, capacity)
                    yield from emit(done)
                    size = sum(len(p.ids) for p in held)
                    names = {p.row: names[p.row] for p in held}
        done, held = assign(held, capacity)
        yield from emit(done + close(held))
    return run


NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, with_ids: bool = True,
         tokenizer: str = TOKENIZER, ranks: str = RANKS) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids).

    Every token of every row lies in exactly one piece, a missing or empty text being its closing token alone. Repeated
    rows are packed as often as they come. `capacity` must be a power of two. `ids` is null unless `with_ids`. An empty
    table gives an empty frame.
    """
    t, k = fresh(docs, "whole_text", "packed_id")
    source = docs.select(F.col(quoted(doc_id)).alias(k), text_of(text).alias(t))
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = source.mapInArrow(
        _packer(tokenizer, ranks, capacity, with_ids),
        f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids array<int>")
    return rows.withColumnRenamed("id", doc_id)
