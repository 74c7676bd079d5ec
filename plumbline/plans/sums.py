"""Long vectors that tasks add up over their rows, added up over all tasks: the inner loop of iterative fits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers that the driver takes from all tasks together; beyond, tasks are added up in lanes and lanes by key first.
DIRECT_VALUES = 1 << 22
#: Values of a row that carries sums, and lanes of the first addition.
CHUNK, LANES = 4_096, 64
#: Rows of the least part that a search starts on, and how many times as many the next one has.
START_ROWS, GROWTH = 100_000, 16
#: How many times as many rows the second part has at least, where the first one is a smaller one.
LEAST_GROWTH = 4


def shares(rows: int) -> list[int]:
    """Parts to search before all rows, as one in so many, the smallest part first; none for a small table."""
    found = []
    while rows >= START_ROWS * GROWTH ** (len(found) + 1):
        found.insert(0, GROWTH ** (len(found) + 1))
    first = 1 << max(0, (rows // START_ROWS).bit_length() - 1)
    # most steps are taken on the first part, so it has START_ROWS rows whatever the size of the table, twice as many at most
    return [first, *found] if found and first >= LEAST_GROWTH * found[0] else found


def add_up(rows: DataFrame, tasks: int, measure: Callable[[Iterator[pd.DataFrame]], dict[int, np.ndarray]], values: int) -> dict[int, np.ndarray]:
    """Sum over all tasks of the vectors that ``measure`` gives for its task's rows, by key.

    ``tasks`` is the number of partitions and ``values`` the length of all vectors of a task together. Either way the
    driver's part is bounded by the vectors, not by the rows; with few tasks they are added in the order of partitions.
    """
    if tasks * values <= DIRECT_VALUES:
        def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found, task = measure(batches), TaskContext.get().partitionId()
            yield pd.DataFrame({"key": list(found), "task": task, "s": [v.tobytes() for v in found.values()]})

        found = rows.mapInPandas(packed, "key int, task int, s binary").toArrow()
        out: dict[int, np.ndarray] = {}
        for key, _, i in sorted(zip(found["key"].to_pylist(), found["task"].to_pylist(), range(found.num_rows))):
            vector = np.frombuffer(found["s"][i].as_buffer())
            out[key] = out[key] + vector if key in out else vector
        return out

    def chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, vector in measure(batches).items():
            parts = [vector[at:at + CHUNK] for at in range(0, len(vector), CHUNK)]
            yield pd.DataFrame({"key": key, "chunk": range(len(parts)), "s": parts})

    parts = rows.mapInPandas(chunked, "key int, chunk int, s array<double>")
    lanes = parts.withColumn("s", array_to_vector("s")).withColumn("lane", F.spark_partition_id() % LANES)
    whole = lanes.groupBy("key", "chunk", "lane").agg(Summarizer.sum(F.col("s")).alias("s")).groupBy("key", "chunk").agg(
        Summarizer.sum(F.col("s")).alias("s"))
    chunks: dict[int, dict[int, np.ndarray]] = {}
    for r in whole.collect():
        chunks.setdefault(r["key"], {})[r["chunk"]] = r["s"].toArray()
    return {key: np.concatenate([found[k] for k in sorted(found)]) for key, found in chunks.items()}
