"""Memory of Python workers."""

from __future__ import annotations

import ctypes
from functools import lru_cache

import pyarrow as pa


@lru_cache(1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give back to the system what this worker no longer uses: workers live on, beside those of the stages that follow."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)
