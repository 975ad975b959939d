"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import shared_dir, stored

__all__ = ["WORD", "held", "shared_dir", "stored", "table", "word_count"]
T = TypeVar("T")
#: White space of the word pattern ``[^\x20\x09-\x0D]+``, in Java's syntax.
WORD = r"[^\x20\x09-\x0D]+"


_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], T]) -> T:
    """This Python worker's cache under ``key``. Another key's takes its place, so that a worker that several
    stages use has one of them at a time."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words ``[^\x20\x09-\x0D]+``; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
