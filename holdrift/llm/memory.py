"""Memory of Python workers, which Spark keeps for later tasks."""

import ctypes
import functools

import pyarrow as pa


def give_back() -> None:
    """Hands freed memory of Arrow and of the C library back to the system, where it knows how."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(task):
    """A function for ``mapInArrow`` whose worker keeps no freed memory when the task has ended."""
    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        give_back()

    return run
