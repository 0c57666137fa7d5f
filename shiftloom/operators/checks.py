"""Quality checks: each returns the offending rows, nothing is printed or raised.

:class:`Watch` takes what can be summed up in the pass that writes a frame, so that a
frame without findings need not be read again.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shiftloom.operators.projection import q, quoted


def duplicate_keys(keys: Sequence[str], out: str = "size"):
    """Keys that occur more than once, with their count."""
    return lambda df: (
        df.dropna("any", subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) != 1)
    )


def distinct_values(col: str):
    return lambda df: df.select(col).distinct()


def gone_but_working(excluded: Sequence[str] = (), *, entity: str = "EID", role: str = "ROLE",
                     value: str = "value", status: str = "rta_status") -> Column:
    """Whether a row shows an analyst at work whom the schedule has as gone."""
    hit = (F.col(role) == "Analyst") & (F.col(value) == "-") & (F.col(status) == "Work")
    return hit & F.coalesce(~F.col(entity).isin(list(excluded)), F.lit(True)) if excluded else hit


def exit_check(excluded: Sequence[str] = (), *, entity: str = "EID", role: str = "ROLE",
               value: str = "value", status: str = "rta_status"):
    """Entities the schedule has as gone although they are seen working."""
    hit = gone_but_working(excluded, entity=entity, role=role, value=value, status=status)
    return lambda df: df.where(hit).select(entity).distinct()


class Watch:
    """Metrics of a frame, gathered while it is written.

    ``keys``: rows without any of them are counted, and the number of different keys is
    estimated (``rsd``: its standard error). ``alarms``: conditions whose rows are
    counted exactly. ``lists``: text columns of few values, which are listed with their
    counts; a column of more than :data:`MOST` values is given up, and takes no more
    memory than that. All of it merges: there is no shuffle and no further job.

    Write :meth:`over` itself. Spark counts a task of the writing stage once however
    often it runs, but it does not so for stages that feed a shuffle.
    """

    MOST = 1024

    def __init__(self, keys: Sequence[str] = (), alarms: Mapping[str, Column] | None = None, lists: Sequence[str] = (), rsd: float = 0.01):
        self.keys, self.alarms, self.lists, self.rsd = list(keys), dict(alarms or {}), list(lists), rsd
        self._seen: Observation | None = None

    def over(self, df: DataFrame) -> DataFrame:
        """``df``, watched from its next action on."""
        metrics = {"rows": F.count(F.lit(1))}
        if self.keys:
            whole = F.lit(True)
            for k in self.keys:
                whole = whole & q(k).isNotNull()
            metrics["keyless"] = F.count_if(~whole)
            metrics["keys"] = F.approx_count_distinct(F.when(whole, F.xxhash64(*map(q, self.keys))), self.rsd)
        metrics |= {f"alarm {name}": F.count_if(hit) for name, hit in self.alarms.items()}
        for i, col in enumerate(self.lists):
            # a sketch holds three quarters of its size exactly
            value = F.coalesce(q(col), F.lit(""))
            metrics[f"list {i}"] = F.expr(f"approx_top_k(coalesce({quoted(col)}, ''), {self.MOST}, {2 * self.MOST})")
            metrics[f"nulls {i}"] = F.count_if(q(col).isNull())
            metrics[f"sum {i}"] = F.sum(F.crc32(value.cast("binary")).cast("decimal(38,0)"))
        self._seen = Observation()
        return df.observe(self._seen, *[metric.alias(name) for name, metric in metrics.items()])

    def _metric(self, name: str):
        if self._seen is None:
            raise ValueError("nothing has been watched")
        return self._seen.get[name]

    @property
    def rows(self) -> int:
        return self._metric("rows")

    @property
    def keyless(self) -> int:
        return self._metric("keyless")

    @property
    def surplus(self) -> int:
        """Estimate of the rows that repeat a key, 0 at least; only :func:`duplicate_keys` is certain."""
        return max(0, self.rows - self.keyless - self._metric("keys"))

    def count(self, alarm: str) -> int:
        return self._metric(f"alarm {alarm}")

    def values(self, col: str) -> dict[str | None, int] | None:
        """Rows per value of a listed column, null included; None if it has too many values."""
        i = self.lists.index(col)
        found = {r["item"]: r["count"] for r in self._metric(f"list {i}") or []}
        # a sketch that ran over has lost or raised counts; then the totals differ
        complete = sum(found.values()) == self.rows and sum(
            n * zlib.crc32(v.encode()) for v, n in found.items()) == int(self._metric(f"sum {i}") or 0)
        if not complete or len(found) >= self.MOST:
            return None
        if nulls := self._metric(f"nulls {i}"):
            found[""] -= nulls
            found[None] = nulls
        return {v: n for v, n in found.items() if n}
