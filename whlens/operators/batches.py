"""Results of many small frames, one per table of a catalog."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame, SparkSession

from whlens.session import shared_dir

#: Frames that one plan holds.
BATCH = 64


def in_batches(spark: SparkSession, frames: Iterable[Callable[[], DataFrame]], schema: str, batch: int = BATCH) -> DataFrame:
    """The rows of all ``frames`` (functions that build them; all of ``schema``).

    Up to ``batch`` frames are one union, not yet run. More are run ``batch`` at a time
    and kept as a table in the shared folder: no plan holds more than ``batch`` frames,
    and a lost executor costs a batch's tasks."""
    frames = iter(frames)
    first = list(islice(frames, batch + 1))
    if not first:
        return spark.createDataFrame([], schema)
    union = lambda part: reduce(DataFrame.unionByName, [make() for make in part])
    if len(first) <= batch:
        return union(first)
    path = f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}"
    at, part, rest = 0, first[:batch], first[batch:]
    while part:
        union(part).coalesce(1).write.parquet(f"{path}/part={at}")
        at, part, rest = at + 1, rest + list(islice(frames, batch - len(rest))), []
    return spark.read.schema(schema).parquet(*[f"{path}/part={i}" for i in range(at)])
