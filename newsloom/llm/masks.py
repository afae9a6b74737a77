"""Bit tables of fixed size over 64-bit numbers, to tell tasks which ones matter.

A set bit may be shared by numbers that were not in the table, so a mask only saves work:
whoever reads it has to decide again what passed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import added_up, landed

#: The leading bits of a number that name its bit: 8 MB.
MASK_BITS = 26


def places(ids: np.ndarray, bits: int) -> np.ndarray:
    return (ids.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def has(mask: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether the bit of each number is set."""
    at = places(ids, len(mask).bit_length() + 2)
    return mask[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def mask_of(ids: DataFrame, bits: int = MASK_BITS) -> np.ndarray:
    """The table of 2 ** ``bits`` bits of the numbers in column ``id``."""
    size = 1 << bits - 3

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.zeros(size, np.uint8)
        for batch in batches:
            at = places(batch.column("id").to_numpy(), bits)
            np.bitwise_or.at(mask, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        yield pa.RecordBatch.from_pydict({"m": [mask.tobytes()]})

    made = ids.select("id").mapInArrow(of_batches, "m binary").select(F.spark_partition_id().cast("long").alias("part"), "m")
    return added_up(landed(made, "bits", "zstd"), "u1", size, np.bitwise_or)
