"""Overlapping windows from disjoint panes.

The windows of several snapshots overlap, so a row belongs to many of them. Their first and last
moments cut time into panes: every window is a run of whole panes. Rows are aggregated once, by pane,
whatever the number of snapshots; only aggregates meet the snapshots. A pane is named by its
first moment, and a window holds a pane exactly when it holds that moment.

Panes of calendar months, cut further at agreed days, do not depend on the snapshots. Aggregates by such
panes can be stored and serve later snapshots too, as long as these fall on a cut day.
"""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from areastats.functions.timewin import as_date, snapshots_covering
from areastats.operators.runs import attach_snapshots

PANE = "pane"
#: No month is shorter, so windows that end by this day of a month also start on it.
LAST_CUT = 28
_MOMENT = "timestamp_ntz"


def _after(moment: Column) -> Column:
    """The next moment: a window ends with the midnight that begins its last day."""
    return moment.cast(_MOMENT) + F.expr("INTERVAL '0.000001' SECOND")


def _latest(cuts: list[Column], moment: Column) -> Column:
    return F.array_max(F.filter(F.array(*cuts), lambda c: c <= moment.cast(_MOMENT)))


def window_pane(moment: Column, snapshots: Sequence[str], months: int) -> Column:
    """First moment of the pane that holds a date or timestamp; null where no window does."""
    ends = [as_date(s) for s in snapshots]
    cuts = [F.add_months(d, -months).cast(_MOMENT) for d in ends] + [_after(d) for d in ends]
    return F.when(F.size(snapshots_covering(moment, snapshots, months)) > 0, _latest(cuts, moment))


def month_pane(moment: Column, cut_days: Sequence[int] = (1,)) -> Column:
    """First moment of the pane of a calendar month; the midnight that begins a cut day is a pane of its own."""
    check_cut_days([], cut_days)
    days = [F.date_add(F.trunc(moment, "MM"), d - 1) for d in sorted({1, *cut_days})]
    cuts = [d.cast(_MOMENT) for d in days] + [_after(d) for d in days]
    return _latest(cuts, moment)


def check_cut_days(snapshots: Sequence[str], cut_days: Sequence[int]) -> None:
    """Raise unless month panes can make up the windows of all snapshots."""
    if not all(1 <= d <= LAST_CUT for d in cut_days):
        raise ValueError(f"cut days must lie between 1 and {LAST_CUT}: {list(cut_days)}")
    for s in snapshots:
        if date.fromisoformat(str(s)).day not in cut_days:
            raise ValueError(f"snapshot {s} is not on a cut day {list(cut_days)}")


def to_windows(aggregates: DataFrame, snapshots: Sequence[str], months: int) -> DataFrame:
    """One copy of each pane's aggregate per snapshot whose window holds it, with snapshot_date for the pane."""
    return attach_snapshots(aggregates, F.col(PANE), snapshots, months).drop(PANE)
