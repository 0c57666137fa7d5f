"""A Bloom filter of fixed size: what may be left out before a shuffle, for certain."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.words import MASK, mix

PROBES = 3


def _place(keys: np.ndarray, probe: int, log_bits: int) -> np.ndarray:
    """Bit of a key for a probe. Keys are mixed hashes: the first probe takes them as they are."""
    spread = mix(keys + np.uint64(0x9E3779B97F4A7C15 * probe & MASK)) if probe else keys
    return (spread >> np.uint64(64 - log_bits)).astype(np.int64)


class Bloom:
    """Knows keys it was built from; takes some others for known, never the reverse.

    Its size is the parameter ``log_bits`` and does not depend on the number of keys:
    with more keys it lets more others pass, which costs work and changes no result.
    """

    def __init__(self, cells: np.ndarray, log_bits: int):
        self.cells, self.log_bits = cells, log_bits

    def __contains__(self, key: int) -> bool:
        return bool(self.known(np.array([key], np.uint64))[0])

    def known(self, keys: np.ndarray) -> np.ndarray:
        left = np.arange(len(keys))
        for probe in range(PROBES):  # few keys are left after the first
            place = _place(keys[left], probe, self.log_bits)
            left = left[(self.cells[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1]
        found = np.zeros(len(keys), bool)
        found[left] = True
        return found

    @classmethod
    def of(cls, keys: DataFrame, log_bits: int) -> Bloom:
        """From a frame with one long column of mixed hashes; 2**log_bits / 64 longs come to the driver at most."""
        name = keys.columns[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)
                place = np.concatenate([_place(values, probe, log_bits) for probe in range(PROBES)])
                bits = np.uint64(1) << (place & 63).astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(place >> 6), pa.array(bits.view(np.int64))], names=["cell", "bits"])

        cells = np.zeros(1 << log_bits - 6, np.uint64)
        marked = keys.mapInArrow(run, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
        if marked.num_rows:
            cells[marked["cell"].to_numpy()] = marked["bits"].to_numpy().view(np.uint64)
        return cls(cells, log_bits)
