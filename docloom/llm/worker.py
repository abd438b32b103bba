"""What a Python worker keeps between its tasks.

The package's functions travel to the executors by value, so its own modules
do not outlive a task there; the interpreter's table of modules does.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

import pyarrow as pa

NAME = "docloom_worker_state"


def once(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()``, called once per process for each ``key``."""
    held = sys.modules.setdefault(NAME, ModuleType(NAME)).__dict__.setdefault("held", {})
    if key not in held:
        held[key] = make()
    return held[key]


def release() -> None:
    """Give memory that a task has freed back to the system: workers outlive their tasks, idle ones too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its memory
        return
