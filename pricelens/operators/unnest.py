"""Unnest: one row per array element (U1-U6), with struct field access (P2-P5).

``keep_empty=False`` is Spark's ``explode``: a row whose array is NULL or empty
disappears. ``keep_empty=True`` is ``explode_outer``: such a row stays once, with
NULL in the element column. Both are generators evaluated row by row inside the
stage's generated code; they never shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_column(path: str | Column) -> Column:
    return F.col(path) if isinstance(path, str) else path


def flatten_present(arrays) -> Column:
    """The elements of all inner arrays; a NULL inner array counts as empty (``F.flatten`` alone gives NULL)."""
    return F.flatten(F.filter(arrays, lambda a: a.isNotNull()))


def unnest(df: DataFrame, path: str | Column, alias: str, keep: Iterable[str | Column] | None = None,
           keep_empty: bool = False) -> DataFrame:
    """Explode the array at ``path`` (a column or a field of a struct column) into ``alias``.

    ``keep`` lists the columns carried next to the element, in output order; by
    default every column of ``df`` except a top-level array being exploded.
    """
    gen = F.explode_outer if keep_empty else F.explode
    target = _as_column(path)
    if keep is None:
        drop = path if isinstance(path, str) and "." not in path else None
        keep = [c for c in df.columns if c != drop]
    return df.select(*[_as_column(c) for c in keep], gen(target).alias(alias))


def struct_fields(struct_col: str, fields: Iterable[str], prefix: str = "") -> list[Column]:
    """``struct_col.f AS prefix+f`` for each field (P2); a missing struct gives NULLs."""
    return [F.col(f"{struct_col}.{f}").alias(f"{prefix}{f}") for f in fields]


def explode_in_place(df: DataFrame, column: str, new_name: str, keep_empty: bool = True) -> DataFrame:
    """U6 + P4: explode an array column where it stands, then rename it (every
    other column keeps its place). ``keep_empty`` keeps NULL and empty arrays as
    one NULL row."""
    gen = F.explode_outer if keep_empty else F.explode
    return df.withColumn(column, gen(F.col(column))).withColumnRenamed(column, new_name)
