"""Row functions in Python, over Arrow batches, for what column expressions cannot say."""

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T


def map_with_setup(
    df: DataFrame,
    setup: Callable[[], Any],
    apply: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    close: Callable[[Any], None] = lambda resource: None,
) -> DataFrame:
    """Map Arrow batches with a resource opened before a task's first row and closed after its last."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for pdf in batches:
                yield apply(resource, pdf)
        finally:
            close(resource)

    return df.mapInPandas(run, schema)


def scalar(fn: Callable[..., pd.Series], kind: T.DataType | str) -> Callable[..., Column]:
    """A scalar function of columns; ``fn`` gets and gives whole Arrow batches as Series."""

    def run(*columns: pd.Series) -> pd.Series:
        return fn(*columns)

    return F.pandas_udf(run, kind)


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """Any number of rows for each row; ``fn`` gets a batch and gives the batch of its results."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return (fn(pdf) for pdf in batches)

    return df.mapInPandas(run, schema)
