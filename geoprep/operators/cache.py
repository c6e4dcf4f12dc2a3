"""Time-limited registry of persisted DataFrames.

An entry holds a persisted DataFrame and the time it was stored; reading it after the
lifetime unpersists and forgets it.  The data itself lives in executor memory/disk
(``MEMORY_AND_DISK``): lost blocks are recomputed from lineage, nothing is collected to
the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from geoprep.spec import CACHE_TTL_MINUTES


@dataclass
class _Entry:
    df: DataFrame
    stored_at: float


class FrameCache:
    def __init__(self, ttl_minutes: float = CACHE_TTL_MINUTES, clock=time.monotonic,
                 level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self.ttl_seconds = ttl_minutes * 60.0
        self._clock = clock
        self._level = level
        self._entries: dict = {}

    def set(self, key: str, df: DataFrame) -> DataFrame:
        """Store (and persist) ``df`` under ``key``, stamping the time."""
        old = self._entries.get(key)
        if old is not None and old.df is not df:
            old.df.unpersist()
        persisted = df if df.storageLevel == self._level else df.persist(self._level)
        self._entries[key] = _Entry(persisted, self._clock())
        return persisted

    def get(self, key: str):
        """The frame if younger than the lifetime (strictly), else None -- an expired entry
        is unpersisted and removed (C2)."""
        e = self._entries.get(key)
        if e is None:
            return None
        if self._clock() - e.stored_at < self.ttl_seconds:
            return e.df
        self.invalidate(key)
        return None

    def invalidate(self, key: str) -> None:
        """Drop one entry."""
        e = self._entries.pop(key, None)
        if e is not None:
            e.df.unpersist()

    def clear(self) -> None:
        """Drop every entry (C4)."""
        for key in list(self._entries):
            self.invalidate(key)

    def __contains__(self, key: str) -> bool:
        return key in self._entries

    def __len__(self) -> int:
        return len(self._entries)

    def get_or_load(self, key: str, loader) -> DataFrame:
        """The cached frame, or ``loader()`` stored under ``key``."""
        df = self.get(key)
        return df if df is not None else self.set(key, loader())
