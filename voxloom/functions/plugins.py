"""Where models plug in: one load for each task, errors kept in the row, and stand-ins without a model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_model(df: DataFrame, column: str, load: Callable[[], Any], apply: Callable[[Any, Any], Any], result: str, name: str = "result") -> DataFrame:
    """Add struct(ok, error, value): the model is loaded once a task, and a row that fails keeps its error."""

    @F.pandas_udf(f"ok boolean, error string, value {result}")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            rows = []
            for x in batch:
                try:
                    rows.append((True, None, apply(model, x)))
                except Exception as e:  # noqa: BLE001 - a model's failure belongs to its row
                    rows.append((False, f"{type(e).__name__}: {e}", None))
            yield pd.DataFrame(rows, columns=["ok", "error", "value"])

    return df.withColumn(name, run(F.col(column)))


def quarantine(df: DataFrame, name: str = "result") -> tuple[DataFrame, DataFrame]:
    """Rows that went well, and those that failed."""
    return df.where(F.col(f"{name}.ok")), df.where(~F.col(f"{name}.ok"))


def first_of(*values: Column) -> Column:
    """Fallback chain: the first value that there is."""
    return F.coalesce(*values)


@F.udtf(returnType="start int, end int")
class VoiceActivity:
    """One signal to the (start, end) in samples of its speech, without a model.

    A frame is loud if its mean square passes the threshold.  Speech goes on over
    up to ``hangover`` quiet frames if a loud one follows them; a stretch of fewer
    than ``least`` frames is dropped.  What follows the last whole frame is not
    looked at.  A null or empty signal has no rows; a null sample is silence.
    """

    def eval(self, signal: list, frame: int, threshold: float, hangover: int = 0, least: int = 1):
        n = len(signal) // frame if signal is not None else 0
        if not n:
            return
        x = np.nan_to_num(np.array(signal[: n * frame], float))
        loud = np.flatnonzero((x * x).reshape(n, frame).mean(1) > threshold)
        if not len(loud):
            return
        breaks = np.flatnonzero(np.diff(loud) > hangover + 1)
        for first, last in zip(loud[np.concatenate([[0], breaks + 1])].tolist(), loud[np.append(breaks, -1)].tolist(), strict=True):
            if last + 1 - first >= least:
                yield first * frame, (last + 1) * frame


def voice_activity(df: DataFrame, signal: str, frame: int, threshold: float, hangover: int = 0, least: int = 1) -> DataFrame:
    """A row for each stretch of speech of each row, with its start and end; rows without speech are absent."""
    found = VoiceActivity(F.col(signal).outer(), F.lit(frame), F.lit(float(threshold)), F.lit(hangover), F.lit(least))
    return df.lateralJoin(found)


def project(vec: Column, layers: list[tuple[np.ndarray, np.ndarray]]) -> Column:
    """A small feed-forward projection: linear layers, normalised and rectified between, tanh at the end."""

    @F.pandas_udf("array<double>")
    def forward(vectors: pd.Series) -> pd.Series:
        x = np.stack(vectors.to_numpy()).astype(float)
        for i, (w, b) in enumerate(layers):
            x = x @ w.T + b
            if i < len(layers) - 1:
                x = np.maximum(0, (x - x.mean(1, keepdims=True)) / (x.std(1, keepdims=True) + 1e-5))
        return pd.Series(list(np.tanh(x)))

    return forward(vec)
