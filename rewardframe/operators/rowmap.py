"""user row functions over a dataset, the slow path.

Native column expressions are preferred everywhere; a user's own Python
``map``/``filter`` function (the reference's ``ds.map(fn)``,
``ds.filter(fn)``) runs here on Arrow batches per partition, never per row
through a row-at-a-time UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch (a pandas frame) of every partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    return df.mapInPandas(run, schema)


def filter_rows(df: DataFrame, pred: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Keep rows where the vectorised predicate is true; schema unchanged."""
    return map_rows(df, lambda b: b[pred(b).astype(bool).to_numpy()], df.schema.simpleString())
