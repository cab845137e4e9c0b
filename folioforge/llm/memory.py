"""Memory of Python workers: they go on to other tasks, and keep what they once had unless it is given back."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return free memory to the system: of Arrow's pool, and of the C library's heap where it can (glibc)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def giving_back(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of a task's batches that gives free memory back when the task ends."""

    def each(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            give_back()

    return each
