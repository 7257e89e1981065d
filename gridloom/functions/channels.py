"""Arrays of channels, lists and retries."""

from __future__ import annotations

import functools
import multiprocessing
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_channels(channels: str, wanted: list[int]) -> Column:
    """The wanted channels of an array, in that order."""
    return F.array(*[F.element_at(channels, i + 1) for i in wanted])


def normalise_channels(channels: str) -> Column:
    """Channels divided by their sum; zeros stay."""
    total = F.aggregate(channels, F.lit(0.0), lambda a, x: a + x)
    return F.when(total != 0, F.transform(channels, lambda x: x / total)).otherwise(F.col(channels))


def extend_list(stored: str, new: str) -> Column:
    """A stored list with what is new at its end, each once."""
    return F.array_union(F.coalesce(F.col(stored), F.expr("cast(array() as array<bigint>)")), F.col(new))


def persist_and_count(df: DataFrame) -> tuple[DataFrame, int, DataFrame]:
    """A persisted table, its rows, and how many each partition has."""
    kept = df.persist()
    return kept, kept.count(), kept.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def auto_retry(times: int, pause: float = 1.0, only_if: Callable[[Exception], bool] = lambda e: True):
    """A decorator that calls again, so many times in all, when a call raises what the predicate accepts."""
    if times < 1:
        raise ValueError("times is at least 1")

    def wrap(fn):
        @functools.wraps(fn)
        def call(*args, **options):
            for left in range(times - 1, -1, -1):
                try:
                    return fn(*args, **options)
                except Exception as e:
                    if not left or not only_if(e):
                        raise
                    time.sleep(pause)

        return call

    return wrap


def _answer(pipe, fn, args) -> None:
    try:
        pipe.send((True, fn(*args)))
    except Exception as e:
        pipe.send((False, e))


def in_subprocess(fn: Callable, timeout: float, *args: Any) -> Any:
    """The function's result from a child process, which is ended after so many seconds (TimeoutError)."""
    context = multiprocessing.get_context("fork")
    here, there = context.Pipe(duplex=False)
    child = context.Process(target=_answer, args=(there, fn, args), daemon=True)
    child.start()
    try:
        if not here.poll(timeout):
            raise TimeoutError(f"no result after {timeout} s")
        good, value = here.recv()
    finally:
        child.kill()
        child.join()
    if not good:
        raise value
    return value
