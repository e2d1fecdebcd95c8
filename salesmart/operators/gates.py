"""Quality gate of a staged load: write, audit, publish.

A load's rows are written where readers do not look yet, measured by the write
job itself, and published only if the measures are within the gate's bounds;
otherwise the load is quarantined with the reasons. The measures are plain
aggregates observed on the rows being written, so the audit costs no pass.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.operators.staging import LOSSY_KEY_PATTERN, REJECT_REASON

#: Shares of a load's rows that a gate can bound, by the measure they come from.
SHARES = {"rejected": "rejected rows", "sales_filled": "rows without sales", "units_filled": "rows without units",
          "keyless": "rows without a key", "lossy_keys": "transaction keys that lost digits"}


@dataclass(frozen=True)
class Gate:
    """Bounds on a load; None bounds nothing. Shares are of the rows read."""

    rejected: float | None = None
    sales_filled: float | None = None
    units_filled: float | None = None
    keyless: float | None = None
    lossy_keys: float | None = None
    min_rows: int | None = None
    first_date: dt.date | None = None
    last_date: dt.date | None = None

    def reasons(self, measures: dict) -> list[str]:
        """Why a load with these measures is not published; empty if it is.
        A load without rows has no shares."""
        rows, out = measures["rows"], []
        for name, what in SHARES.items():
            bound = getattr(self, name)
            if bound is not None and rows and measures[name] > bound * rows:
                out.append(f"{what}: {measures[name]} of {rows}")
        if self.min_rows is not None and rows < self.min_rows:
            out.append(f"rows: {rows}, at least {self.min_rows} wanted")
        if self.first_date is not None and measures["min_dt"] is not None and measures["min_dt"] < self.first_date:
            out.append(f"first date: {measures['min_dt']}")
        if self.last_date is not None and measures["max_dt"] is not None and measures["max_dt"] > self.last_date:
            out.append(f"last date: {measures['max_dt']}")
        return out


def measures() -> list[Column]:
    """Aggregates over ``clean_transactions`` rows that a gate looks at."""
    keyless = F.col("trans_key").isNull() | F.col("product_key").isNull() | F.col("store_location_key").isNull()
    return [F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(REJECT_REASON).isNotNull()).alias("rejected"),
            F.count_if(F.col("sales_was_missing")).alias("sales_filled"),
            F.count_if(F.col("units_was_missing")).alias("units_filled"),
            F.count_if(keyless).alias("keyless"),
            F.count_if(F.col("trans_key").rlike(LOSSY_KEY_PATTERN)).alias("lossy_keys"),
            F.min("trans_dt").alias("min_dt"), F.max("trans_dt").alias("max_dt")]


def parse(text: str) -> Gate:
    """A gate from ``name=value`` pairs, such as ``rejected=0.05,min_rows=1``."""
    kinds = {f.name: str(f.type) for f in fields(Gate)}
    values: dict = {}
    for pair in filter(None, (p.strip() for p in text.split(","))):
        name, _, value = pair.partition("=")
        if name not in kinds:
            raise ValueError(f"unknown bound {name!r}; expected one of {sorted(kinds)}")
        kind = kinds[name]
        values[name] = int(value) if kind.startswith("int") else float(value) if kind.startswith("float") else dt.date.fromisoformat(value)
    return Gate(**values)
