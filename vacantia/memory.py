"""Memory of Python workers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import cache

import pyarrow as pa


@cache
def _trim() -> Callable[[int], object] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not this C library
        return None


def give_back() -> None:
    """Hand memory that is free in this worker back to the machine. A worker outlives its task, and what its allocators keep
    would stand beside what the next stage's workers take."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)
