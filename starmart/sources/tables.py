"""Tables by name, each made when it is first asked for.

A query then stages and loads what it reads and no more; every table that is read is made by the same steps,
from the same rows, as when all of them are made.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping, MutableMapping

from pyspark.sql import DataFrame


class Tables(MutableMapping):
    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made, self._lock = dict(makers), {}, threading.RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._made:
                self._made[name] = self._makers[name]()
            return self._made[name]

    def __setitem__(self, name: str, table: DataFrame) -> None:
        with self._lock:
            self._makers[name], self._made[name] = (lambda: table), table

    def __delitem__(self, name: str) -> None:
        with self._lock:
            del self._makers[name]
            self._made.pop(name, None)

    def __iter__(self) -> Iterator[str]:
        return iter(list(self._makers))

    def __len__(self) -> int:
        return len(self._makers)


def replaced(tables: Mapping[str, DataFrame], makers: Mapping[str, Callable[[], DataFrame]]) -> Tables:
    """``tables`` with some of them made another way; ``tables`` stays as it is."""
    return Tables({name: (lambda name=name: tables[name]) for name in tables} | dict(makers))
