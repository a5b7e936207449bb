"""Date-window expressions. Foldable when the snapshot is a literal, so they push down to scans."""

from datetime import date

from pyspark.sql import Column, functions as F


def as_date(snapshot) -> Column:
    """Accept a Column, a date or an ISO string."""
    if isinstance(snapshot, Column):
        return snapshot.cast("date")
    if isinstance(snapshot, date):
        return F.lit(snapshot)
    return F.lit(date.fromisoformat(snapshot))


def window_start(snapshot, months: int) -> Column:
    return F.add_months(as_date(snapshot), -months)


def window_bounds(snapshot, months: int) -> Column:
    """struct(start, end): `months` months back from the snapshot, both ends included."""
    return F.struct(window_start(snapshot, months).alias("start"), as_date(snapshot).alias("end"))


def months_in_window(snapshot, months: int) -> Column:
    """The `months` yyyy-MM strings that end with the snapshot's month, ascending."""
    end = as_date(snapshot)
    back = F.sequence(F.lit(months - 1), F.lit(0), F.lit(-1))
    return F.transform(back, lambda i: F.date_format(F.add_months(end, -i), "yyyy-MM"))


def in_window(moment: Column, snapshot, months: int) -> Column:
    return moment.between(window_start(snapshot, months), as_date(snapshot))


def month_in_window(month: Column, snapshot, months: int) -> Column:
    """Months are yyyy-MM strings, so the window is a plain string range (prunes partitions)."""
    first = F.date_format(F.add_months(as_date(snapshot), 1 - months), "yyyy-MM")
    return month.between(first, F.date_format(as_date(snapshot), "yyyy-MM"))


def years_in_window(snapshot, months: int) -> Column:
    """Every calendar year the window touches, the middle ones included."""
    return F.sequence(F.year(window_start(snapshot, months)), F.year(as_date(snapshot)))


def year_in_window(year: Column, snapshot, months: int) -> Column:
    return year.between(F.year(window_start(snapshot, months)), F.year(as_date(snapshot)))


def snapshot_dates(start, end, step_months: int = 3) -> Column:
    """Every `step_months` months from start, end excluded."""
    return F.sequence(
        as_date(start), F.date_sub(as_date(end), 1), F.make_interval(months=F.lit(step_months))
    )


def default_snapshot(today: Column | None = None) -> Column:
    """First day of the month of `today`, the current date by default."""
    return F.trunc(F.current_date() if today is None else today, "MM")


def snapshots_covering(moment: Column, snapshots: list, months: int) -> Column:
    """The snapshots whose window holds `moment`: a row-local filter, no range join."""
    known = F.array(*[as_date(s) for s in snapshots])
    return F.filter(known, lambda s: moment.between(F.add_months(s, -months), s))


def snapshots_covering_month(month: Column, snapshots: list, months: int) -> Column:
    """As `snapshots_covering` for yyyy-MM strings: the snapshot's month is the last one."""
    known = F.array(*[as_date(s) for s in snapshots])
    return F.filter(known, lambda s: month_in_window(month, s, months))


def month_of_claim_label(label: Column) -> Column:
    """'december_2025' -> '2025-12'."""
    return F.date_format(F.to_date(label, "MMMM_yyyy"), "yyyy-MM")


def claim_month(month: Column) -> Column:
    """yyyy-MM from either form of month; raises on any other text."""
    return F.when(month.rlike(r"^[0-9]{4}-[0-9]{2}$"), month).when(
        month.rlike("^[a-z]+_[0-9]{4}$"), month_of_claim_label(month)
    ).when(month.isNotNull(), F.raise_error(F.concat(F.lit("not a month of claims: "), month)))
