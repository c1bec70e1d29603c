"""Window frames that wait: a value only once the frame holds enough rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Series:
    """A series within each group of ``by``, along ``order``. Every window operator takes one: no operator works on an
    unpartitioned table, which would be one task."""

    by: tuple[str, ...]
    order: str

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(self.order)

    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.by)

    def rows(self, first: int, last: int = 0) -> WindowSpec:
        return self.ordered().rowsBetween(first, last)

    def so_far(self) -> WindowSpec:
        return self.ordered().rowsBetween(Window.unboundedPreceding, 0)

    def rest(self) -> WindowSpec:
        return self.ordered().rowsBetween(0, Window.unboundedFollowing)

    def number(self) -> Column:
        return F.row_number().over(self.ordered())


def rolling(kind: str, x: Column, s: Series, width: int, least: int | None = None, y: Column | None = None, before: bool = False) -> Column:
    """mean, sum, median, std or corr over the last ``width`` rows (this one included, or those ``before`` it), null until
    ``least`` rows (default: all of them) hold a value."""
    frame = s.rows(-width, -1) if before else s.rows(-(width - 1), 0)
    enough = F.count(x).over(frame) >= (width if least is None else least)
    if kind == "corr":  # corr() itself fails on a frame without spread
        spread = F.stddev_samp(x).over(frame) * F.stddev_samp(y).over(frame)
        return F.when(enough, F.try_divide(F.covar_samp(x, y).over(frame), F.when(spread != 0, spread)))
    made = {"mean": F.avg, "sum": F.sum, "median": lambda c: F.percentile(c, 0.5), "std": F.stddev_samp}[kind](x)
    return F.when(enough, made.over(frame))


def slope(x: Column, number: Column, s: Series, width: int, least: int | None = None) -> Column:
    """Slope of the least-squares line over the row number, made a column before."""
    frame = s.rows(-(width - 1), 0)
    return F.when(F.count(x).over(frame) >= (width if least is None else least), F.regr_slope(x, number).over(frame))


def change(x: Column, s: Series, lag: int = 1) -> Column:
    """Relative change over ``lag`` rows; null where there is none or the earlier value is 0."""
    old = F.lag(x, lag).over(s.ordered())
    return F.try_divide(x - old, F.when(old != 0, old))


def interpolated(x: Column, s: Series, number: Column) -> Column:
    """Gaps filled linearly by row number; behind the last value it stays, before the first it is null."""
    at = F.when(x.isNotNull(), number)
    left, right = F.last(x, ignorenulls=True).over(s.so_far()), F.first(x, ignorenulls=True).over(s.rest())
    a, b = F.last(at, ignorenulls=True).over(s.so_far()), F.first(at, ignorenulls=True).over(s.rest())
    return F.coalesce(x, left + (right - left) * F.try_divide((number - a).cast("double"), b - a), left)
