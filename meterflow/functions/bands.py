"""Seasons and parts of the day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month ranges of the history scheme (inclusive, they overlap, the first
# match wins) and of the quarter scheme.
SEASONS = {
    "history": [("Winter", 1, 3), ("Spring", 4, 6), ("Summer", 6, 8), ("Fall", 8, 12)],
    "quarter": [("Winter", 1, 3), ("Spring", 4, 6), ("Summer", 7, 9), ("Fall", 10, 12)],
}

# Hour bands of a day, inclusive.
DAYPARTS = [("night", 0, 6), ("morning", 7, 8), ("working", 9, 16), ("evening", 17, 23)]

# Expected range of one report per hour band, and the seasons that raise it.
PROFILE_BANDS = [
    (0, 6, 0.06, 0.21),
    (7, 8, 0.2, 0.7),
    (9, 16, 0.1, 0.35),
    (17, 23, 0.2, 0.7),
]
SEASON_FACTORS = {"Winter": 1.4, "Spring": 1.0, "Summer": 1.4, "Fall": 1.0}


def _first_match(value: Column, ranges) -> Column:
    chain = F
    for label, low, high in ranges:
        chain = chain.when(value.between(low, high), label)
    return chain


def season(month: Column | str, scheme: str = "history") -> Column:
    """Season of a month number; null outside 1..12."""
    return _first_match(F.col(month) if isinstance(month, str) else month, SEASONS[scheme])


def daypart(hour: Column | str) -> Column:
    """Part of the day of an hour; null outside 0..23."""
    return _first_match(F.col(hour) if isinstance(hour, str) else hour, DAYPARTS)


def season_factor(month: Column | str, factors: dict[str, float] | None = None) -> Column:
    """Factor of the quarter season of a month."""
    factors = SEASON_FACTORS if factors is None else factors
    name = season(month, "quarter")
    chain = F
    for label, factor in factors.items():
        chain = chain.when(name == label, float(factor))
    return chain.otherwise(1.0)
