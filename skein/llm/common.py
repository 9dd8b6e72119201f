"""Helpers that the text operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import mark, remove, scratch, shared_dir, sweep, written

__all__ = ["keeps", "let", "mark", "only", "release", "remove", "scratch", "shared_dir", "sweep", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What operators keep in a Python worker from task to task: by name, how to drop it.
_kept: dict[str, Callable[[], None]] = {}


def keeps(name: str, drop: Callable[[], None]) -> None:
    _kept[name] = drop


def only(*names: str) -> None:
    """At the start of a task: what other operators have kept in this worker goes."""
    for name, drop in _kept.items():
        if name not in names:
            drop()


def release() -> None:
    """Gives a Python worker's freed memory back to the system, at the end of a task: the worker waits for the next one beside others."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body names it.

    Spark evaluates what a lambda captures again for each element; a lambda variable
    is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
