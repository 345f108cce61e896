"""Where the zones of one lake lie under its root folder."""

from __future__ import annotations

from dataclasses import dataclass

from monthlake.months import BatchMonth
from monthlake.schema import BATCH_MONTH


@dataclass(frozen=True)
class Zones:
    """Paths below ``root``, which may be any path Spark can write to."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def source(self) -> str:
        return f"{self.root}/source"

    @property
    def curated(self) -> str:
        return f"{self.root}/curated"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    def raw_month(self, month: BatchMonth) -> str:
        return f"{self.raw}/{month.label}"

    def source_month(self, month: BatchMonth) -> str:
        return f"{self.source}/{month.partition}"

    def curated_month(self, month: BatchMonth) -> str:
        return f"{self.curated}/{month.partition}"

    def rejected_month(self, month: BatchMonth) -> str:
        return f"{self.rejected}/{BATCH_MONTH}={month.label}"
