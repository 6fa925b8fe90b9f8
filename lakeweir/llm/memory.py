"""Memory of Python processes: workers, which live on from task to task, and the driver."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def release() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def freeing(run: Callable) -> Callable:
    """An Arrow function that gives freed memory back to the system when its task ends.

    Otherwise a worker keeps the most it ever had in use, beside the executor's heap.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return task
