"""Frame blocks: how ordered operators stay parallel inside one long clip.

An ordered operator partitioned by clip alone puts a long clip into one task.
Here every ordered partition is (keys, block of consecutive frames), so a clip that
holds a third of all rows is spread over as many tasks as it has blocks:

* bounded look-around: neighbours are copied into the adjacent block (``over_halo``);
* unbounded look-around: a row looks inside its block, and one summary row per block
  carries the rest (``bracket``, ``ranked``, ``running_compose``).

Frames are 32-bit, so with 4096-frame blocks a clip has at most 2**19 summary rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
BEFORE = Window.unboundedPreceding


def block_of(order: str | Column, block: int = BLOCK) -> Column:
    c = F.col(order) if isinstance(order, str) else order
    return F.floor(c / F.lit(block)).cast("int")


def halo(df: DataFrame, before: int, after: int, order: str = "frame", block: int = BLOCK) -> DataFrame:
    """Copy each row into every block whose rows look at it; ``_own`` marks the original."""
    if before < 0 or after < 0:
        raise ValueError("look-around must not be negative")
    f = F.col(order)
    blocks = F.sequence(block_of(f - after, block), block_of(f + before, block))
    return (
        df.withColumn("_block", F.explode(blocks))
        .withColumn("_own", F.col("_block") == block_of(order, block))
    )


def over_halo(df: DataFrame, keys: Sequence[str], before: int, after: int,
              body: Callable[[DataFrame, object, object], DataFrame],
              order: str = "frame", block: int = BLOCK) -> DataFrame:
    """Run ``body(rows, ascending, descending)`` per (keys, block) with neighbours at hand."""
    rows = halo(df, before, after, order, block)
    part = Window.partitionBy(*keys, "_block")
    out = body(rows, part.orderBy(order), part.orderBy(F.col(order).desc()))
    return out.filter("_own").drop("_own", "_block")


def over_rows(df: DataFrame, keys: Sequence[str], before: int, after: int,
              body: Callable[[DataFrame, object, object], DataFrame],
              order: str = "frame", block: int = BLOCK) -> DataFrame:
    """As ``over_halo``, but neighbours are the nearest rows, however far their frames lie.

    Rows are ranked first, so frames may be missing anywhere and the answer does not
    depend on where blocks end.
    """
    rows = ranked(df, keys, [order], block_of(order, block), "_rank")
    return over_halo(rows, keys, before, after, body, "_rank", block).drop("_rank")


def previous(df: DataFrame, keys: Sequence[str], payload: Column, out: str, order: str = "frame",
             block: int = BLOCK) -> DataFrame:
    """The payload struct of the row before, at any distance; NULL on the first row."""
    rows = df.withColumns({"_block": block_of(order, block), "_pay": payload})
    last = rows.groupBy(*keys, "_block").agg(F.max_by("_pay", order).alias("_hi"))
    carried = last.select(*keys, "_block", F.lag("_hi").over(Window.partitionBy(*keys).orderBy("_block")).alias("_cp"))
    near = F.lag("_pay").over(Window.partitionBy(*keys, "_block").orderBy(order))
    return rows.withColumn("_lp", near).join(carried, [*keys, "_block"]).withColumn(
        out, F.coalesce("_lp", "_cp")).drop("_block", "_pay", "_lp", "_cp")


def bracket(df: DataFrame, keys: Sequence[str], anchor: Column, payload: Column,
            prev: str = "prev", next_: str = "next", order: str = "frame", block: int = BLOCK,
            next_anchor: Column | None = None) -> DataFrame:
    """Nearest anchor at or before (``prev``) and at or after (``next_``) every row.

    ``payload`` is the struct taken from the anchor row. This is a two-sided as-of
    join of a table with its own anchor rows, at any distance. ``next_anchor`` lets the
    forward side look for other rows than the backward side.
    """
    after = anchor if next_anchor is None else next_anchor
    rows = df.withColumns({"_block": block_of(order, block), "_a": F.when(anchor, payload), "_b": F.when(after, payload)})
    part = Window.partitionBy(*keys, "_block")
    running = lambda w: w.rowsBetween(BEFORE, 0)
    local = (
        rows.withColumn("_p", F.last("_a", True).over(running(part.orderBy(order))))
        .withColumn("_n", F.last("_b", True).over(running(part.orderBy(F.col(order).desc()))))
    )
    at = lambda c: F.when(F.col(c).isNotNull(), F.col(order))
    edges = rows.groupBy(*keys, "_block").agg(
        F.max_by("_a", at("_a")).alias("_hi"), F.min_by("_b", at("_b")).alias("_lo"))
    per_key = Window.partitionBy(*keys)
    carried = edges.select(
        *keys, "_block",
        F.last("_hi", True).over(per_key.orderBy("_block").rowsBetween(BEFORE, -1)).alias("_cp"),
        F.last("_lo", True).over(per_key.orderBy(F.col("_block").desc()).rowsBetween(BEFORE, -1)).alias("_cn"),
    )
    return (
        local.join(carried, [*keys, "_block"], "left")
        .withColumn(prev, F.coalesce("_p", "_cp"))
        .withColumn(next_, F.coalesce("_n", "_cn"))
        .drop("_p", "_n", "_cp", "_cn", "_a", "_b", "_block")
    )


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, out: str = "rank",
           counts: bool = False) -> DataFrame:
    """0-based rank by ``order`` within ``keys``, sorting one bucket per task.

    ``bucket`` must grow with ``order``. Bucket sizes are counted first and summed up
    to start offsets, so no task sorts a whole key. ``counts`` adds ``<out>_n``, the
    number of rows of the key.
    """
    rows = df.withColumn("_bucket", bucket)
    per_key = Window.partitionBy(*keys)
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(
        *keys, "_bucket",
        F.coalesce(F.sum("_n").over(per_key.orderBy("_bucket").rowsBetween(BEFORE, -1)), F.lit(0)).alias("_base"),
        *([F.sum("_n").over(per_key).alias(f"{out}_n")] if counts else []),
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        rows.withColumn("_r", F.row_number().over(inside))
        .join(starts, [*keys, "_bucket"])
        .withColumn(out, F.col("_base") + F.col("_r") - 1)
        .drop("_base", "_r", "_bucket")
    )


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                    accuracy: int = 10000) -> DataFrame:
    """Exact linearly interpolated quantiles per key, safe for a hot key.

    A bounded-memory sketch brackets each quantile (its rank error is at most
    1/accuracy); only the values inside the bracket are counted and ordered.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    # Equal values collapse map-side, so the value table is never larger than the input.
    names = list(probs)
    margin = 2.0 / accuracy
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.percentile_approx("_v", max(0.0, probs[p] - margin), accuracy).alias(f"_lo_{p}") for p in names],
        *[F.percentile_approx("_v", min(1.0, probs[p] + margin), accuracy).alias(f"_hi_{p}") for p in names],
    )
    # All probabilities in one pass: each value is placed in the zone of every bracket.
    tagged = rows.join(sketch, list(keys))
    val = F.col("_v")

    def placed(i: int, p: str) -> Column:
        zone = F.when(val < F.col(f"_lo_{p}"), F.lit(0)).when(val > F.col(f"_hi_{p}"), F.lit(2)).otherwise(F.lit(1))
        return F.struct(F.lit(i).alias("p"), zone.alias("z"), F.when(zone == 1, val).alias("key"))

    cells = tagged.select(*keys, "_n", "_v", F.explode(F.array(*[placed(i, p) for i, p in enumerate(names)])).alias("_at"))
    # Outside the bracket only the count and the nearest value matter.
    cells = cells.groupBy(*keys, "_n", F.col("_at.p").alias("_p"), F.col("_at.z").alias("_z"), F.col("_at.key").alias("_key")).agg(
        F.count(F.lit(1)).alias("_c"), F.max("_v").alias("_mx"), F.min("_v").alias("_mn"))
    run = Window.partitionBy(*keys, "_p").orderBy("_z", F.col("_key"))
    pos = F.element_at(F.array(*[F.lit(float(probs[p])) for p in names]), F.col("_p") + 1) * (F.col("_n") - 1)
    spans = cells.withColumn("_to", F.sum("_c").over(run.rowsBetween(BEFORE, 0))).withColumn(
        "_from", F.col("_to") - F.col("_c")).withColumn("_pos", pos)
    pick = F.when(F.col("_z") == 2, F.col("_mn")).when(F.col("_z") == 0, F.col("_mx")).otherwise(F.col("_key"))

    def value(i: int) -> Column:
        def at(rank: Column) -> Column:
            holds = (F.col("_p") == i) & (F.col("_from") <= rank) & (rank < F.col("_to"))
            return F.max(F.when(holds, pick))

        low, high = at(F.floor("_pos")), at(F.ceil("_pos"))
        frac = F.max(F.when(F.col("_p") == i, F.col("_pos") - F.floor("_pos")))
        return low + (high - low) * frac

    return spans.groupBy(*keys).agg(*[value(i).alias(p) for i, p in enumerate(names)], F.max("_n").alias("n"))


def running_compose(df: DataFrame, keys: Sequence[str], order: str, schema: str,
                    prefix: Callable[[pd.DataFrame, object], tuple[pd.DataFrame, object]],
                    state_cols: Sequence[str], state_schema: str, block: int = 1024) -> DataFrame:
    """Running product of an associative step along ``order``, block by block.

    ``prefix(rows, carried)`` returns the rows with their running value and the value
    after the last row. Blocks are folded in parallel, their totals are chained (one
    row per block), then each block is folded again from the value carried into it.
    """
    rows = df.withColumn("_block", block_of(order, block))
    names = list(keys)
    cols = list(state_cols)

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        _, last = prefix(pdf.sort_values(order), None)
        head = pdf.iloc[:1][[*names, "_block"]].reset_index(drop=True)
        return pd.concat([head, last.reset_index(drop=True)], axis=1)

    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*names).schema)
    totals = rows.groupBy(*names, "_block").applyInPandas(total, f"{key_schema}, _block int, {state_schema}")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block").reset_index(drop=True)
        run, _ = prefix(pdf, None)
        shifted = run[cols].shift(1).rename(columns={c: f"_in_{c}" for c in cols})
        return pd.concat([run[[*names, "_block"]], shifted], axis=1).astype(object).where(
            lambda d: d.notna(), None)

    in_schema = ", ".join("_in_" + part.strip() for part in state_schema.split(", "))
    carried = totals.groupBy(*names).applyInPandas(chain, f"{key_schema}, _block int, {in_schema}")

    wanted = [part.split()[0] for part in schema.split(", ")]

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order).reset_index(drop=True)
        start = pdf.iloc[0][[f"_in_{c}" for c in cols]]
        start = None if start.iloc[0] is None or (isinstance(start.iloc[0], float) and pd.isna(start.iloc[0])) else \
            pd.DataFrame([{c: start[f"_in_{c}"] for c in cols}])
        run, _ = prefix(pdf, start)
        return run[wanted]

    joined = rows.join(carried, [*names, "_block"], "left")
    return joined.groupBy(*names, "_block").applyInPandas(finish, schema)
