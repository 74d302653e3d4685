"""Stored tables as the dashboard views take them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from fieldstay.sources.store import Snapshot


class StoredTables(Mapping):
    """The tables of one snapshot by name. ``within`` reads only the folders that may have rows in a range of a column
    whose range is kept, such as a task's finish: a window on it opens the folders it meets, however long the history."""

    def __init__(self, snapshot: Snapshot):
        self.snapshot = snapshot

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        return self.snapshot.read(name)

    def __contains__(self, name: object) -> bool:
        return name in self.snapshot.tables

    def __iter__(self) -> Iterator[str]:
        return iter(self.snapshot.tables)

    def __len__(self) -> int:
        return len(self.snapshot.tables)

    def within(self, name: str, **ranges: tuple[str, str]) -> DataFrame:
        return self.snapshot.read(name, **ranges)
