"""Memory of Python workers."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Return memory that this process has freed but still holds, as workers live on between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
