"""Lazy access to every bronze, silver and gold frame over one bronze source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tierline.plans.silver import base_columns, refine


class Layers:
    """Builds each frame once, on first use. Nothing runs until a caller's action.

    `bronze` and `silver` are loaders by table name; `silver` defaults to refining bronze, and a
    run that has written its silver tables passes a loader that scans them instead.
    """

    def __init__(
        self,
        bronze: Callable[[str], DataFrame],
        silver: Callable[[str], DataFrame] | None = None,
    ) -> None:
        self._load_bronze = bronze
        self._load_silver = silver
        self._frames: dict[tuple[str, str], DataFrame] = {}

    def _once(self, layer: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if (layer, name) not in self._frames:
            self._frames[layer, name] = build()
        return self._frames[layer, name]

    def use(self, layer: str, name: str, df: DataFrame) -> None:
        """Read this frame from now on, for instance the scan of a table just written."""
        self._frames[layer, name] = df

    def bronze(self, name: str) -> DataFrame:
        return self._once("bronze", name, lambda: self._load_bronze(name))

    def silver(self, name: str) -> DataFrame:
        if self._load_silver:
            return self._once("silver", name, lambda: self._load_silver(name))
        return self._once("silver", name, lambda: refine(name, self.bronze(name), self.reference))

    def reference(self, name: str, *columns: str) -> DataFrame:
        """Plain silver columns of a parent table; silver keeps every row, so bronze serves as well."""
        if self._load_silver:
            return self.silver(name).select(*columns)
        return base_columns(name, self.bronze(name), *columns)

    def gold(self, name: str) -> DataFrame:
        from tierline.plans.gold import GOLD

        return self._once("gold", name, lambda: GOLD[name](self))
