"""Inputs whose columns may have any name, those that an operator uses itself included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def apart(docs: DataFrame, work: Callable[..., DataFrame], **columns: str) -> DataFrame:
    """``work`` on ``docs`` under neutral column names; its result, of the same columns, under the old ones.

    ``columns`` are names of columns that ``work`` takes as keyword arguments; one that ``docs`` has not goes as it is.
    """
    names = docs.columns
    places = {c: f"c{i}" for i, c in enumerate(names)}
    return work(docs.toDF(*places.values()), **{k: places.get(c, c) for k, c in columns.items()}).toDF(*names)
