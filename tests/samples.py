"""Random bookings as the CSV delivers them: text only, columns in the source's order."""

from __future__ import annotations

import random

from wayfare.sources.spec import BOOKINGS

CHOICES = {
    "hotel": ("City Hotel", "Resort Hotel"),
    "arrival_date_month": ("January", "April", "August", "November"),
    "meal": ("BB", "HB", "FB", "SC", "Undefined"),
    "reserved_room_type": ("A", "D", "F", "H"),
    "assigned_room_type": ("A", "D", "F", "H"),
    "market_segment": ("Direct", "Groups", "Online TA"),
    "reservation_status": ("Check-Out", "Canceled"),
    "country": ("PRT", "GBR", "FRA"),
}
RANGES = {
    "is_canceled": (0, 1), "arrival_date_year": (2015, 2017), "arrival_date_day_of_month": (1, 28), "lead_time": (0, 300),
    "stays_in_weekend_nights": (0, 2), "stays_in_week_nights": (1, 5), "adults": (1, 3), "children": (0, 2), "adr": (0, 250),
}


def booking(rng: random.Random, **fixed: str) -> dict[str, str]:
    """One valid booking; ``fixed`` sets columns by name."""
    row = {}
    for column in BOOKINGS.columns:
        if column in CHOICES:
            row[column] = rng.choice(CHOICES[column])
        elif column in BOOKINGS.ints or column in BOOKINGS.floats:
            row[column] = str(rng.randint(*RANGES.get(column, (0, 1))))
        elif column == "reservation_status_date":
            row[column] = f"2017-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        else:
            row[column] = rng.choice(("x", "y"))
    return row | fixed


def table(spark, rows: list[dict[str, str]]):
    return spark.createDataFrame([tuple(r[c] for c in BOOKINGS.columns) for r in rows], ", ".join(f"`{c}` string" for c in BOOKINGS.columns))
