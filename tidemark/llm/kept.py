"""What a Python process keeps from task to task: things of one kind at a time."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import pyarrow as pa

_KEPT: dict = {}
_kind = None


def of(kind: str) -> dict:
    """What this process keeps of ``kind``; all that it kept of another kind goes, and its memory goes back to the machine."""
    global _kind
    if kind != _kind:
        _kind = kind
        if _KEPT:
            _KEPT.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # a C library without it
                ctypes.CDLL(None).malloc_trim(0)
    return _KEPT
