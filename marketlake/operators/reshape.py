"""Unions and the wide-to-long melt."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_int, lenient_number


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column one of them lacks is null there.

    Halves are joined first, so that a thousand frames make a plan ten unions deep.
    """
    if len(frames) < 3:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    middle = len(frames) // 2
    return union_by_name(union_by_name(*frames[:middle]), union_by_name(*frames[middle:]))


def union_roles(roles: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Frames of one shape stacked, with their role in column ``tag``."""
    return union_by_name(*[df.withColumn(tag, F.lit(role)) for role, df in roles.items()])


def melt_wide(
    df: DataFrame,
    ids: Sequence[str] = ("ticker", "year", "quarter"),
    name: str = "ind_name",
    value: str = "value",
) -> DataFrame:
    """One row per indicator column. The id columns are the first ones, bound by position.

    Nulls are kept. Year and quarter are read as integers, values as doubles; what cannot
    be read is null. The melt is an Expand: no shuffle, and a filter on an id column moves
    below it.
    """
    id_count = len(ids)
    indicators = df.columns[id_count:]
    if not indicators:
        raise ValueError("no indicator column after the id columns")
    types = {f.dataType for f in df.schema.fields[id_count:]}
    numeric = all(isinstance(t, T.NumericType) for t in types)
    columns = []
    for target, field in zip(ids, df.schema.fields):
        c = F.col(f"`{field.name}`")
        if target in ("year", "quarter"):
            c = as_int(df, c)
        columns.append(c.alias(target))
    columns += [
        F.col(f"`{c}`").cast("double" if numeric else "string").alias(c) for c in indicators
    ]
    long = df.select(*columns).unpivot(list(ids), [f"`{c}`" for c in indicators], name, value)
    return long if numeric else long.withColumn(value, lenient_number(F.col(value)))
