"""Where the bronze / silver / gold layers live, resolved from one base URI."""

from __future__ import annotations

import os
from dataclasses import dataclass

BASE_ENV = "TRIPFLOW_BASE"

GOLD_TIME_TABLES = ("by_hour", "by_dayofweek", "by_date", "by_dow_hour")
GOLD_VENDOR_TABLES = ("by_vendor", "by_payment", "by_pickup_location_top20", "by_route_top50")


@dataclass(frozen=True)
class Layout:
    """Layer paths under ``base`` (any Hadoop URI: hdfs://, s3a://, file:/...).

    ``dataset`` names one month / batch of trips inside each layer.
    """

    base: str
    dataset: str = "trips"

    @classmethod
    def from_env(cls, default: str | None = None, dataset: str = "trips") -> "Layout":
        base = default or os.environ.get(BASE_ENV)
        if not base:
            raise ValueError(f"no base given and {BASE_ENV} is unset")
        return cls(base, dataset)

    def _join(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._join("bronze", "raw", self.dataset)

    @property
    def silver(self) -> str:
        return self._join("silver", "cleaned", self.dataset)

    @property
    def gold_time(self) -> str:
        return self._join("gold", "aggregated_by_time", self.dataset)

    @property
    def gold_vendor(self) -> str:
        return self._join("gold", "aggregated_by_vendor", self.dataset)

    @property
    def reports(self) -> str:
        return self._join("reports", self.dataset)

    @property
    def sketches(self) -> str:
        """Quantile sketches of silver by day."""
        return self._join("silver", "sketches", self.dataset)

    @property
    def parts(self) -> str:
        """Distinct bronze rows of a month that arrives in parts."""
        return self._join("bronze", "parts", self.dataset)

    @property
    def ledger(self) -> str:
        """Finished steps of a run."""
        return self._join("ledger", self.dataset)

    def rollup(self, name: str) -> str:
        """Stored partial aggregates that gold tables are derived from."""
        return self._join("gold", "rollups", self.dataset, name)

    def gold(self, table: str) -> str:
        if table in GOLD_TIME_TABLES:
            return f"{self.gold_time}/{table}"
        if table in GOLD_VENDOR_TABLES:
            return f"{self.gold_vendor}/{table}"
        raise KeyError(f"unknown gold table {table!r}")
