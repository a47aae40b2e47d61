"""Tables that are opened only when asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    """Name to DataFrame, where each is made on first use and then kept.

    Opening a table lists its files and reads a footer or header; a report that
    needs two of eight tables does so for those two only.
    """

    def __init__(
        self,
        makers: Mapping[str, Callable[[], DataFrame]],
        counted_from: Mapping[str, Callable[[], DataFrame]] | None = None,
    ) -> None:
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}
        self._counted_from = dict(counted_from or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def to_count_keys(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """A table with the same frequent keys as ``name``: the one it is made from where that is known, else itself.

    Counting the keys of a table that is not stored would otherwise make it a second time.
    """
    known = getattr(tables, "_counted_from", {})
    return known[name]() if name in known else tables[name]
