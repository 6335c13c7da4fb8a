"""What a Python worker keeps from one task to the next: one store at a time, and no memory that tasks have freed.

Workers live on from stage to stage. A store that speeds up one operator (judged words, ids of words) is of no use to the next
one, and memory that a task has freed stays with the worker unless it is handed back.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa

_held: list[tuple[Hashable, object]] = []


def held(key: Hashable, make: Callable[[], object]):
    """The store of that key, from an earlier task or made now; any other one is let go."""
    if not _held or _held[0][0] != key:
        _held.clear()
        give_back()
        _held.append((key, make()))
    return _held[0][1]


def give_back() -> None:
    """Freed memory back to the system, as far as the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator], Iterator], keep: bool = False) -> Callable[[Iterator], Iterator]:
    """A task's function that hands freed memory back when it ends and, unless `keep`, lets go of other operators' stores first."""

    def tidied(batches: Iterator) -> Iterator:
        if not keep:
            _held.clear()
            give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
