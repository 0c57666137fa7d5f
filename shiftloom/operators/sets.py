"""Row unions and distinct rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def stack(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_distinct(*frames: DataFrame) -> DataFrame:
    """As :func:`stack`, equal rows (nulls included) once."""
    return stack(*frames).distinct()
