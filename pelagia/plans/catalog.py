"""Names to DataFrames: raw tables, and products computed from them on demand."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Product = Callable[["Catalog"], DataFrame]
PRODUCTS: dict[str, Product] = {}


def product(name: str) -> Callable[[Product], Product]:
    """Register a product function under its published name."""

    def keep(fn: Product) -> Product:
        PRODUCTS[name] = fn
        return fn

    return keep


class Catalog:
    """Resolves a name to a stored frame, a raw table, or a product built from others."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, Callable[[], DataFrame] | DataFrame]):
        self.spark = tune(spark)
        self._raw = raw
        self._known: dict[str, DataFrame] = {}
        self._reads: dict[str, set[str]] = {}
        self._open: list[str] = []
        self._stored: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if self._open:
            self._reads[self._open[-1]].add(name)
        if name not in self._known:
            if name in self._raw:
                source = self._raw[name]
                self._known[name] = source() if callable(source) else source
            elif name in PRODUCTS:
                self._reads[name] = set()
                self._open.append(name)
                try:
                    self._known[name] = PRODUCTS[name](self)
                finally:
                    self._open.pop()
            else:
                raise KeyError(f"no table or product named {name!r}")
        return self._known[name]

    def has(self, name: str) -> bool:
        """Whether ``name`` is at hand as a frame: a raw table, or something put or planned before."""
        return name in self._known or name in self._raw

    def stored(self, name: str) -> bool:
        """Whether ``name`` was given or put, so that it is read rather than computed."""
        return name in self._stored or name in self._raw

    def reads(self, name: str) -> set[str]:
        """The tables and products that planning ``name`` has asked this catalog for."""
        self[name]
        return self._reads.get(name, set())

    def put(self, name: str, df: DataFrame) -> None:
        """Use a stored frame for ``name`` from now on; what was planned over the old one is dropped."""
        self.forget(name)
        self._known[name] = df
        self._stored.add(name)

    def forget(self, name: str) -> None:
        """Plan ``name``, and all that was planned over it, anew when it is asked for."""
        stale = [name]
        while stale:
            gone = stale.pop()
            readers = [r for r, asked in self._reads.items() if gone in asked and r in self._known]
            for reader in readers:
                del self._known[reader]
            stale += readers
        if name in PRODUCTS:
            self._known.pop(name, None)
            self._stored.discard(name)
