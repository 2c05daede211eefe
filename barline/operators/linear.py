"""Least squares per series: the pass over the rows is a Spark aggregate, the solve a small batch.

``gram_sums`` reduces any number of rows to one array per series with map-side partial aggregation.
What is left, one small symmetric matrix per series, is solved in Arrow batches with NumPy.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.schema import SERIES


def _partial_sums(batches):
    for pdf in batches:
        if pdf.empty:
            continue
        order = np.argsort(pdf["key"].to_numpy(), kind="stable")  # one matrix per key, however the rows lie
        keys = pdf["key"].to_numpy()[order]
        rows = np.stack(pdf["row"].to_numpy())[order]
        upper = np.triu_indices(rows.shape[1])
        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        runs = [rows[a:b] for a, b in zip(edges[:-1], edges[1:])]
        yield pd.DataFrame({"key": keys[edges[:-1]], "part": [(r.T @ r)[upper] for r in runs]})


def gram_sums(df: DataFrame, x: Column, y: Column, key: str = SERIES) -> DataFrame:
    """Sums of all products of (1, x..., y), upper triangle row by row, in the array column ``gram``.

    ``x`` is an array of equal length on every row.  Rows with a missing regressor or target are left
    out.  The first element is the row count, the last the sum of squares of the target.  Each Arrow
    batch is reduced to one partial matrix per key, so a key of any size is summed
    piecewise before the shuffle.
    """
    row = F.concat(F.array(F.lit(1.0)), x, F.array(y.cast("double")))
    kind = dict(df.select(key).dtypes)[key]
    return (
        df.select(F.col(key).alias("key"), row.alias("row"))
        .where(F.forall("row", lambda v: v.isNotNull()))
        .mapInPandas(_partial_sums, f"key {kind}, part array<double>")
        .groupBy(F.col("key").alias(key))
        .agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("gram"))
    )


def unpack(grams, k: int) -> np.ndarray:
    """Upper triangles back to a batch of symmetric k x k matrices; zeros for a series without rows."""
    g = np.zeros((len(grams), k, k))
    rows, cols = np.triu_indices(k)
    if len(grams):
        flat = np.stack([np.zeros(len(rows)) if x is None else x for x in grams])
        g[:, rows, cols] = flat
        g[:, cols, rows] = flat
    return g


def solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Batched solve; singular systems give NaN and a False flag instead of an error."""
    out = np.full(b.shape, np.nan)
    if a.shape[-1] == 0:
        return out, np.ones(len(a), dtype=bool)
    scale = np.sqrt(np.einsum("nii->ni", a))
    safe = np.where(scale > 0, scale, 1.0)
    scaled = a / safe[:, :, None] / safe[:, None, :]
    ok = np.isfinite(scaled).all(axis=(1, 2)) & (scale > 0).all(axis=1)
    ok[ok] = np.linalg.cond(scaled[ok]) < 1e12
    if ok.any():
        solution = np.linalg.solve(scaled[ok], (b[ok] / safe[ok])[:, :, None])[:, :, 0]
        out[ok] = solution / safe[ok]
    return out, ok
