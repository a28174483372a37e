"""The batch a load runs for."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Batch:
    source_system: str
    domain: str
    cycle_date: date
    batch_id: int
    run_ts: datetime
    frequency: str = "DAILY"

    @property
    def table_name(self) -> str:
        return f"{self.source_system}_{self.domain}"

    @property
    def cycle_number(self) -> int:
        return int(self.cycle_date.strftime("%Y%m%d"))

    def cycle(self) -> Column:
        return F.lit(self.cycle_date)

    def number(self) -> Column:
        return F.lit(self.batch_id).cast("int")

    def recorded(self) -> Column:
        return F.lit(self.run_ts)

    def originates(self, cycle: str = "original_cycle_date", number: str = "original_batch_id") -> Column:
        """True for rows that first arrived in this batch."""
        return (F.col(cycle) == self.cycle()) & (F.col(number) == self.number())

    def precedes(self, cycle: str = "original_cycle_date", number: str = "original_batch_id") -> Column:
        """True for rows that first arrived in another batch."""
        return F.col(cycle).isNotNull() & F.col(number).isNotNull() & ~self.originates(cycle, number)
