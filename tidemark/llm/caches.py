"""What workers remember: one operator's at a time.

A Python worker lives on from stage to stage. What an operator has learnt about words stays for its next tasks, and
goes when another operator begins, so that the stages of a pipeline don't add up in an executor's memory.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable

import pyarrow as pa

class Recent(dict):
    """A dict of bounded size that keeps what was used of late: two generations of at most `most` entries.

    `find` moves what it finds in the older generation to the younger one; a full young generation becomes
    the old one, whose entries go.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most = most
        self.old: dict = {}

    def turn(self, coming: int) -> None:
        """Make room for so many entries; those used since the turn before last may go."""
        if len(self) and len(self) + coming > self.most:
            self.old = dict(self)
            self.clear()

    def find(self, keys) -> list:
        """The keys that aren't known; all others are in the young generation from now on."""
        old, missing = self.old, []
        for key in keys:
            if key not in self:
                value = old.get(key)
                if value is None:
                    missing.append(key)
                else:
                    self[key] = value
        return missing


_clear: dict[str, Callable[[], object]] = {}
_owner: list[str] = [""]


def claim(name: str, clear: Callable[[], object]) -> None:
    """Say that `name` uses its memory now; `clear` empties it when another operator says so."""
    if _owner[0] == name:
        return
    _clear[name] = clear
    for other, forget in _clear.items():
        if other != name:
            forget()
    give_back()
    _owner[0] = name


def give_back() -> None:
    """Return to the system what was freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
