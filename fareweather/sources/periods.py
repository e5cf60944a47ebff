"""Monthly periods: bounds, labels and day ranges."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta


def _first_day(month: str) -> date:
    return date.fromisoformat(f"{month}-01")


def _next_month(day: date) -> date:
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1)


@dataclass(frozen=True)
class Period:
    """A half-open range of days made of months.

    The range runs from the earliest to the latest month; a gap between them is
    not detected.
    """

    months: tuple[str, ...]

    @classmethod
    def of(cls, months: Iterable[str]) -> "Period":
        ordered = tuple(sorted(months))
        if not ordered:
            raise ValueError("at least one month is needed")
        return cls(ordered)

    @property
    def start(self) -> date:
        return _first_day(self.months[0])

    @property
    def end(self) -> date:
        """First day after the period."""
        return _next_month(_first_day(self.months[-1]))

    @property
    def last_day(self) -> date:
        """Last day inside the period, as hourly weather services expect it."""
        return self.end - timedelta(days=1)

    @property
    def hours(self) -> int:
        return (self.end - self.start).days * 24

    @property
    def label(self) -> str:
        if len(self.months) == 1:
            return self.months[0]
        return f"{self.months[0]}_to_{self.months[-1]}"
