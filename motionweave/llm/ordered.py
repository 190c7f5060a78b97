"""Rows in one global order: laid out once by range, numbered within a key, hashed as a stream. No key goes through one sort."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

# Fixed value: how Spark numbers rows, partition above, row below.
ROW_BITS = 33


def laid(df: DataFrame, *order: str | Column) -> DataFrame:
    """The rows in the given order (nulls first), split by range and written, with their place ``at`` in it.

    One exchange; a key of any size is spread over as many ranges as it fills. Rows that are equal in all of ``order``
    share a range.
    """
    out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(out.withColumn("at", F.monotonically_increasing_id()))


def placed(rows: DataFrame, key: str, out: str) -> DataFrame:
    """Number the rows of every key from 0 by ``at``: place within the range, plus the key's rows in earlier ranges."""
    rows = rows.withColumn("_range", F.shiftright("at", ROW_BITS))
    runs = rows.groupBy(key, "_range").agg(F.min("at").alias("_low"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(key, "_range", (F.col("_low") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_zero"))
    return rows.join(starts, [key, "_range"]).withColumn(out, F.col("at") - F.col("_zero")).drop("_range", "_zero")


def streamed(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], step, schema: str) -> DataFrame:
    """``step(batches)`` over whole keys in order: batches of dictionaries of lists, one range of keys per task.

    Rows arrive sorted by key and order; Spark's sort spills, and the step holds only its own state.
    """
    rows = df.repartition(*key).sortWithinPartitions(*key, *order)
    return rows.mapInArrow(step, schema)


def digests(parts: DataFrame, key: str, order: Sequence[str | Column], part: str, out: str, glue: str = ",") -> DataFrame:
    """SHA-256 of the parts of every key, joined in order, fed to the digest part by part."""
    kind = parts.schema[key].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, schema = None, None, None
        for batch in batches:
            schema = pa.schema([batch.schema.field(key), pa.field(out, pa.string())])
            done: list[tuple] = []
            for k, text in zip(batch.column(key).to_pylist(), batch.column(part).to_pylist()):
                if state is None or k != at:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    at, state = k, hashlib.sha256()
                else:
                    state.update(glue.encode())
                state.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done), schema)], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], schema[0].type), pa.array([state.hexdigest()])], schema=schema)

    return streamed(parts.select(key, *[o for o in order if isinstance(o, str)], part), [key], order, step, f"{key} {kind}, {out} string")
