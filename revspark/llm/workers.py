"""Memory that Python workers give back.

Spark keeps a worker for later tasks.  What a step allocated and freed stays
with the worker's allocators, and counts for its executor through all steps
that run after it, in Python or not.
"""

from __future__ import annotations

import functools

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system."""
    import ctypes           # here, as this module is pickled by value
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def lean(task):
    """``task`` of ``mapInArrow``; its worker gives back what the task freed."""
    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()
    return run


def few_rows(batches, rows: int = 1024):
    """Batches of fewer rows: a task holds what it makes of these, not of the 64 MB that Spark sends at once."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
