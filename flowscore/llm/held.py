"""What a Python worker holds between tasks: the tables of one operator at a time, and no memory that Arrow is done with.

Workers are used again by the stages that follow, so without this one that has run all stages of a job holds the tables
of all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa

_HELD: dict[tuple, Any] = {}


def held(key: tuple, make: Callable[[], Any]) -> Any:
    """The table of this key, made once in each worker; it takes the place of any other."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Hold no table; for tasks that need none."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after each, what Arrow took for it and no longer uses goes back to the system."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
