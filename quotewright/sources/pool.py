"""Calls that wait on a service, several at once inside a task, with one limit for all tasks together."""

from __future__ import annotations

import itertools
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame

X, Y = TypeVar("X"), TypeVar("Y")


def in_order(items: Iterable[X], work: Callable[[X], Y], threads: int) -> Iterator[Y]:
    """``work`` of each item, in the items' order, up to ``threads`` at once.

    Items are taken only as results leave: at most twice as many as threads are under way or wait for an earlier one.
    """
    if threads <= 1:
        yield from map(work, items)
        return
    source, ahead = iter(items), deque()
    with ThreadPoolExecutor(threads) as pool:
        try:
            for item in itertools.islice(source, 2 * threads):
                ahead.append(pool.submit(work, item))
            while ahead:
                yield ahead.popleft().result()
                for item in itertools.islice(source, 1):
                    ahead.append(pool.submit(work, item))
        finally:
            for f in ahead:
                f.cancel()


def share(limit: int, parts: int, part: int) -> int:
    """Threads of task number ``part``, so that ``parts`` tasks have ``limit`` together, one at least each."""
    return max(1, limit // parts + (part < limit % parts))


def spread(rows: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """``rows`` in at most ``limit`` partitions, and their number: fewer than the limit where the cluster has fewer slots.

    As each task runs :func:`share` threads, no more than ``limit`` calls are open at any time, however many slots are free.
    """
    parts = max(1, min(limit, rows.sparkSession.sparkContext.defaultParallelism))
    return rows.repartition(parts), parts


def retried(work: Callable[[], Y], attempts: int, wait: float, longest: float) -> tuple[Y | None, str | None, int]:
    """(result, None, tries) of up to ``attempts`` tries with doubling waits, or (None, the last error, tries)."""
    for attempt in range(attempts):
        try:
            return work(), None, attempt + 1
        except Exception as e:  # noqa: BLE001  one item's failure stops no other
            error = f"{type(e).__name__}: {e}"
            if attempt < attempts - 1:
                time.sleep(min(longest, wait * 2**attempt))
    return None, error, attempts
