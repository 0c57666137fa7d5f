"""Wide to long, long to wide, one cell to many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.operators.projection import columns_between, quoted


def unpivot(ids: Sequence[str] | tuple[str, str], values: Sequence[str] | None = None,
            variable: str = "date", value: str = "value", ids_are_range: bool = False):
    """One row per id row and value column; null cells are kept.

    Cells are cast to text first, as a schedule mixes codes and numbers. Without
    ``values`` every column that is not an id is unpivoted.
    """

    def op(df: DataFrame) -> DataFrame:
        id_cols = columns_between(df, ids[0], ids[1]) if ids_are_range else list(ids)
        cells = [c for c in df.columns if c not in id_cols] if values is None else list(values)
        names = {c: quoted(c) for c in [*id_cols, *cells]}
        texts = df.selectExpr(
            *[names[c] for c in id_cols], *[f"CAST({names[c]} AS STRING) AS {names[c]}" for c in cells]
        )
        return texts.unpivot([names[c] for c in id_cols], [names[c] for c in cells], variable, value)

    return op


def pivot_groups(keys: Sequence[str], pivot: str, values: Sequence, agg: Column):
    """Long to wide with the wanted values given, so no extra pass looks for them."""
    return lambda df: df.groupBy(*keys).pivot(pivot, list(values)).agg(agg)


def conditional_max(keys: Sequence[str], status: str, measure: str, columns: dict[str, str]):
    """``{output: status}``: the greatest measure of each status, one column per status."""
    return lambda df: df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(status) == s, F.col(measure).cast("double"))).alias(c) for c, s in columns.items()]
    )


def split_columns(col: str, sep: str, names: Sequence[str]):
    """Literal split into a fixed number of columns; missing pieces are null."""

    def op(df: DataFrame) -> DataFrame:
        parts = F.split(F.col(col), "\\Q" + sep + "\\E")
        return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)})

    return op


def entity_ids(cell: Column, outer: str = "@", inner: str = "#", skip: int = 16) -> Column:
    """All ids in a multi-value cell as an array, in order, without repeats.

    The first piece is an id. Every later piece carries ``skip`` characters of
    markup and then two texts around ``inner``, the second being the id.
    """
    pieces = F.split(cell, "\\Q" + outer + "\\E")

    def id_in(piece: Column, i: Column) -> Column:
        tail = F.substring(piece, F.lit(skip + 1), F.length(piece))
        return F.when(i == 0, piece).otherwise(F.get(F.split(tail, "\\Q" + inner + "\\E"), F.lit(1)))

    return F.array_compact(F.array_distinct(F.transform(pieces, id_in)))


def unnest_ids(cell: str, out: str, **layout):
    """One row per id of a multi-value cell. Row-local: no join back, no shuffle."""
    return lambda df: df.withColumn(out, F.explode_outer(entity_ids(F.col(cell), **layout)))
