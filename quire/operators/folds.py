"""Ordered folds over groups of rows.

Groups are made by one shuffle on their keys and one sort inside the partitions; Python then walks the
Arrow batches and hands each group to the fold. Small groups cost no call across the worker's border of
their own, and only one group is held in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Fold = Callable[[list], Iterable[tuple]]


def fold_groups(df: DataFrame, keys: list[str], order: list[str | Column], fold: Fold, schema: str) -> DataFrame:
    """Rows that ``fold`` makes of the ordered rows (named tuples) of each group."""
    names = [part.split()[0] for part in schema.split(", ")]
    spread = F.xxhash64(*keys)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator:
        for b in batches:
            yield from b.astype(object).where(b.notna(), None).itertuples(index=False)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for _, group in groupby(rows(batches), key=lambda r: tuple(getattr(r, k) for k in keys)):
            out.extend(fold(list(group)))
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    return df.repartition(spread).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)
