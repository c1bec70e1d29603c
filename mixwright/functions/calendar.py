"""Calendar columns: waves, flags, trends and the holidays of the United States."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def fourier(d: Column, terms: int = 2) -> dict[str, Column]:
    """Waves of the year and, up to three, of the week (Monday is 0)."""
    out = {}
    for i in range(1, terms + 1):
        year = F.dayofyear(d) * (2 * math.pi * i) / 365.25
        out |= {f"sin_year_{i}": F.sin(year), f"cos_year_{i}": F.cos(year)}
    for i in range(1, min(terms, 3) + 1):
        week = F.weekday(d) * (2 * math.pi * i) / 7
        out |= {f"sin_week_{i}": F.sin(week), f"cos_week_{i}": F.cos(week)}
    return out


def weekdays(d: Column) -> dict[str, Column]:
    return {f"is_{n}": (F.weekday(d) == i).cast("int") for i, n in enumerate(DAYS)} | {"is_weekend": (F.weekday(d) >= 5).cast("int")}


def cyclic(d: Column) -> dict[str, Column]:
    wave = lambda x, n: ((x * (2 * math.pi)) / n)
    parts = {"month": wave(F.month(d), 12), "quarter": wave(F.quarter(d), 4), "week": wave(F.weekofyear(d), 52), "day": F.day(d) * (2 * math.pi) / F.day(F.last_day(d))}
    return {f"{f.__name__}_{n}": f(x) for n, x in parts.items() for f in (F.sin, F.cos)}


def _nth(year: int, month: int, weekday: int, n: int) -> dt.date:
    first = dt.date(year, month, 1)
    return first + dt.timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))


def _last(year: int, month: int, weekday: int) -> dt.date:
    end = dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(1)
    return end - dt.timedelta((end.weekday() - weekday) % 7)


def easter(year: int) -> dt.date:
    """Gregorian Easter by the golden number, the epact and the Sunday letter."""
    golden = year % 19
    century = year // 100
    epact = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    epact -= (epact // 28) * (1 - (29 // (epact + 1)) * ((21 - golden) // 11))
    weekday = (year + year // 4 + epact + 2 - century + century // 4) % 7
    offset = epact - weekday
    month = 3 + (offset + 40) // 44
    return dt.date(year, month, offset + 28 - 31 * (month // 4))


def holidays(first: int, last: int) -> list[tuple[dt.date, str]]:
    """(date, name) of each holiday of each year."""
    out = []
    for y in range(first, last + 1):
        thanksgiving, sunday = _nth(y, 11, 3, 4), easter(y)
        out += [
            (dt.date(y, 1, 1), "new_year"), (_nth(y, 1, 0, 3), "mlk_day"), (_nth(y, 2, 0, 3), "presidents_day"), (_last(y, 5, 0), "memorial_day"), (dt.date(y, 7, 4), "independence_day"),
            (_nth(y, 9, 0, 1), "labor_day"), (_nth(y, 10, 0, 2), "columbus_day"), (dt.date(y, 11, 11), "veterans_day"), (thanksgiving, "thanksgiving"), (dt.date(y, 12, 25), "christmas"),
            (sunday - dt.timedelta(2), "good_friday"), (sunday, "easter"), (thanksgiving + dt.timedelta(1), "black_friday"), (thanksgiving + dt.timedelta(4), "cyber_monday"),
        ]
    return out


#: Holidays by kind, for fewer columns.
GROUPS = {"shopping": ("black_friday", "cyber_monday"), "winter": ("thanksgiving", "christmas", "new_year"), "spring": ("easter", "good_friday")}


def observed(d: dt.date) -> dt.date:
    """The day a holiday is kept on: Friday for Saturday, Monday for Sunday."""
    return d + dt.timedelta({5: -1, 6: 1}.get(d.weekday(), 0))


def holiday_table(spark: SparkSession, first: int, last: int) -> DataFrame:
    """A row for each holiday: 14 a year, so that it may be broadcast."""
    return spark.createDataFrame(holidays(first, last), "holiday_date date, holiday string")
