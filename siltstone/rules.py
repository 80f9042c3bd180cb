"""Parameters of one warehouse run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The domains, calendar bounds, alert threshold and column
# lengths the warehouse is specified with.
REGIONS = ("EUW", "EUNE", "NA", "KR")
SEGMENTS = ("casual", "core", "whale")
RARITIES = ("Default", "Legacy", "Epic", "Legendary", "Ultimate")
CALENDAR_START = date(2010, 1, 1)
CALENDAR_END = date(2030, 12, 31)
ALERT_THRESHOLD_PCT = Decimal("5.0")
NAME_LENGTH = 100
SKIN_NAME_LENGTH = 200
RARITY_LENGTH = 50
REGION_LENGTH = 10
SEGMENT_LENGTH = 20
REASON_LENGTH = 200
LOG_LENGTH = 100

POLICIES = ("fail", "drop", "quarantine")


@dataclass(frozen=True)
class Rules:
    """Domains, bounds and policies; the defaults are the specified values.

    ``on_violation`` says what happens to rows that break a declared
    constraint: ``fail`` stops the load, ``drop`` leaves the rows out,
    ``quarantine`` leaves them out and keeps them in a table of their own.
    """

    regions: tuple[str, ...] = REGIONS
    segments: tuple[str, ...] = SEGMENTS
    rarities: tuple[str, ...] = RARITIES
    calendar_start: date = CALENDAR_START
    calendar_end: date = CALENDAR_END
    as_of: date | None = None
    alert_threshold_pct: Decimal = ALERT_THRESHOLD_PCT
    region_length: int = REGION_LENGTH
    on_violation: str = "fail"

    def __post_init__(self) -> None:
        if self.on_violation not in POLICIES:
            raise ValueError(f"on_violation must be one of {POLICIES}, got {self.on_violation!r}")
        if self.calendar_end < self.calendar_start:
            raise ValueError("the calendar ends before it starts")

    def today(self) -> Column:
        """The date ages are counted from: ``as_of``, or the current date."""
        return F.current_date() if self.as_of is None else F.lit(self.as_of)
