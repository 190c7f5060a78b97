"""The extension point for models: a user function over frame batches or windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .schedule import to_frames


def infer_frames(frames: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Call ``fn`` on Arrow batches of frame rows; it returns raw detections."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield fn(batch)

    return frames.mapInPandas(run, schema)


def infer_windows(frames: DataFrame, windows: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                  schema: str) -> DataFrame:
    """Call ``fn`` once per (clip, window) with the frames of that window, in order.

    A group is one window, whose length the schedule bounds.
    """
    rows = frames.join(to_frames(windows.select("clip", "win", "start", "end")).hint("merge"), ["clip", "frame"])
    return rows.groupBy("clip", "win").applyInPandas(
        lambda pdf: fn(pdf.sort_values("frame").reset_index(drop=True)), schema)
