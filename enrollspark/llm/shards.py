"""Shards of bounded size that stay in their task while rows of another table stream past them.

The residents of a shard come first in their partition and are held together; visitors
follow in batches. A task holds one shard and one batch at a time, however many
visitors there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrollspark.llm.common import row_salt


class Shard(Protocol):
    def visit(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """What a batch of visitors gives."""

    def close(self) -> Iterator[pd.DataFrame]:
        """What the shard gives after its last visitor."""


def deal_rows(staged: DataFrame, rows: int, out: str = "shard") -> tuple[DataFrame, int]:
    """Add ``out``, a shard of about ``rows`` rows, by file and row, so that no value makes a shard large; and the number of shards."""
    n = max(1, -(-staged.count() // rows))
    return staged.select("*", F.pmod(row_salt(), F.lit(n)).cast("int").alias(out)), n


def _stream(open_shard: Callable[[int, pd.DataFrame], Shard]):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, shard = None, [], None
        for part in parts:
            for key, some in part.groupby("shard", sort=True):
                if key != at:
                    if held and shard is None:
                        shard = open_shard(int(at), pd.concat(held, ignore_index=True))
                    if shard is not None:
                        yield from shard.close()
                    at, held, shard = key, [], None
                mine, others = some[some["visits"] == 0], some[some["visits"] == 1]
                if len(mine):
                    held.append(mine)
                if len(others) and held:
                    if shard is None:
                        shard = open_shard(int(at), pd.concat(held, ignore_index=True))
                    yield from shard.visit(others)
        if held and shard is None:
            shard = open_shard(int(at), pd.concat(held, ignore_index=True))
        if shard is not None:
            yield from shard.close()

    return run


def visit_shards(residents: DataFrame, visitors: DataFrame, shards: int, open_shard: Callable[[int, pd.DataFrame], Shard], schema: str) -> DataFrame:
    """What the shards of ``residents`` make of ``visitors``; both have a column shard, and may differ in the others.

    Visitors of a shard without residents give nothing.
    """
    both = residents.withColumn("visits", F.lit(0)).unionByName(visitors.withColumn("visits", F.lit(1)), allowMissingColumns=True)
    both = both.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "visits")
    return both.mapInPandas(_stream(open_shard), schema)


def by_length(rows: pd.DataFrame, column: str = "vec") -> Iterator[tuple[int, pd.DataFrame]]:
    """The rows by the length of their vectors."""
    yield from ((int(n), some) for n, some in rows.groupby(rows[column].map(len)))


def wide(vectors: pd.Series, length: int, dtype=np.int64) -> np.ndarray:
    """Vectors of one length as the rows of an array."""
    return np.array(vectors.tolist(), dtype).reshape(len(vectors), length)
