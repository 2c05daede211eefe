import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog.check import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("8")


def walk(n, seed=1, start="2018-01-01", base=100.0, step=0.5):
    """Bars on business days: the close drifts by Laplace steps around a slow wave, the day's range is drawn
    anew for every bar and holds open and close, and volume grows with the size of the move."""
    rng = np.random.default_rng(seed)
    moves = rng.laplace(scale=step / 2, size=n)
    close = base + np.cumsum(moves) + 2 * step * np.sin(np.arange(n) / 40.0)
    opened = close - moves * rng.uniform(0.2, 0.8, n)
    reach = rng.gamma(2.0, step, (2, n)) + 0.05
    return pd.DataFrame({
        "date": pd.bdate_range(start, periods=n).date,
        "open": opened, "high": np.maximum(opened, close) + reach[0], "low": np.minimum(opened, close) - reach[1], "close": close,
        "volume": np.round(40_000 * (1 + np.abs(moves) / step) * rng.lognormal(0, 0.2, n)),
    })


def panel(spark, frames):
    """A bars table from frames by series name; NaN becomes NULL."""
    whole = pd.concat([f.assign(series=s) for s, f in frames.items()], ignore_index=True)
    rows = whole.astype(object).where(whole.notna(), None)
    kinds = {"series": "string", "date": "date", "split": "string", "ingest_ordinal": "long", "model": "string"}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in rows.columns)
    return spark.createDataFrame(list(rows.itertuples(index=False, name=None)), schema)


def by_key(df, *keys):
    """Collected rows by key."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
