"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.vec import let

# The white space that separates words, as a class and as plain characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; a missing one is empty."""
    return F.coalesce(F.col(quoted(column)), F.lit(""))


def words_of(text: Column) -> Column:
    """Words between white space, as an array; none for an empty or blank text."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_CLASS))


def nullable_key(column: str) -> Column:
    """A key that equals itself for missing values too and differs from every real value."""
    return F.coalesce(F.concat(F.lit("="), F.col(quoted(column))), F.lit("-"))


def before(values: Column, zero: Column, op: Callable[[Column, Column], Column], step: int = 64) -> Column:
    """For each element of an array the fold of all elements before it.

    Stretches of `step` elements are folded first and then chained, so an array of n costs about n * step / 2 + (n / step)^2
    steps and nothing grows by copying.
    """
    def over(v: Column) -> Column:
        n = F.size(v)
        starts = F.sequence(F.lit(1), n, F.lit(step))
        stretches = F.transform(starts, lambda s: F.aggregate(F.slice(v, s, F.lit(step)), zero, op))

        def chained(t: Column) -> Column:
            def of(s: Column, i: Column) -> Column:
                inside = F.sequence(F.lit(0), F.least(F.lit(step), n - s + 1) - 1)
                return let(F.aggregate(F.slice(t, F.lit(1), i), zero, op),
                           lambda b: F.transform(inside, lambda j: F.aggregate(F.slice(v, s, j), b, op)))
            return F.flatten(F.transform(starts, of))

        return F.when(n > 0, let(stretches, chained)).otherwise(F.slice(F.array(zero), F.lit(1), F.lit(0)))

    return let(values, over)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet, made from the given ones."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def settle(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of steps whose results are written: it does so for plans that nobody holds."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def quoted(name: str) -> str:
    return "`" + re.sub("`", "``", name) + "`"
