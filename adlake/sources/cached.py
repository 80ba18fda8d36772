"""A DataFrame kept for a time: read again after `ttl` seconds or when told to."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame


class CachedFrame:
    def __init__(self, load: Callable[[], DataFrame], ttl: float = 3600.0):
        self.load, self.ttl, self.at, self.df = load, ttl, 0.0, None

    def get(self, force: bool = False) -> DataFrame:
        """The frame; an empty one is an error, as a crawl without makes would close every ad."""
        if self.df is None or force or time.time() - self.at > self.ttl:
            fresh = self.load().persist()
            if fresh.isEmpty():
                fresh.unpersist()
                raise ValueError("nothing loaded")
            if self.df is not None:
                self.df.unpersist()
            self.df, self.at = fresh, time.time()
        return self.df

    def refresh(self) -> DataFrame:
        return self.get(force=True)

    def info(self) -> dict:
        return {"cached": self.df is not None, "age": time.time() - self.at if self.df is not None else None, "ttl": self.ttl}
