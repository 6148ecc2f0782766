"""Scalar expressions, Column in and Column out. All stay inside generated code; no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stallwise import contract


def as_timestamp(c: Column) -> Column:
    """Local time without a zone; text that is no timestamp (an empty CSV field) becomes null."""
    return c.try_cast("timestamp_ntz")


def as_double(c: Column) -> Column:
    return c.cast("double")


def as_int(c: Column) -> Column:
    return c.cast("int")


def lenient_double(c: Column) -> Column:
    """Number or null: text that is no number does not fail the job."""
    return c.try_cast("double")


def normalized_text(c: Column) -> Column:
    return F.lower(F.trim(c))


def upper_code(c: Column) -> Column:
    return F.upper(c)


def default_if_null(c: Column, label: str) -> Column:
    return F.coalesce(c, F.lit(label))


def default_if_blank(c: Column, label: str) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(label))


def status_group(status: Column) -> Column:
    branches = iter(contract.STATUS_GROUPS.items())
    name, members = next(branches)
    chain = F.when(status.isin(members), F.lit(name))
    for name, members in branches:
        chain = chain.when(status.isin(members), F.lit(name))
    return chain.otherwise(F.lit(contract.OTHER_STATUS))


def flag(predicate: Column) -> Column:
    """0/1, and null where the predicate is null."""
    return predicate.cast("int")


def calendar_days(start: Column, end: Column) -> Column:
    """Midnights passed from start to end, null if either is null."""
    return F.datediff(F.to_date(end), F.to_date(start))


def delivery_days(is_delivered: Column, purchased: Column, delivered: Column) -> Column:
    return F.when(is_delivered == 1, calendar_days(purchased, delivered))


def delay_days(is_delivered: Column, estimated: Column, delivered: Column) -> Column:
    return F.when(is_delivered == 1, calendar_days(estimated, delivered))


def late_flag(is_delivered: Column, estimated: Column, delivered: Column) -> Column:
    """Compares instants, so a delivery later on the promised day is late although delay_days is 0."""
    return F.when(is_delivered == 1, flag(delivered > estimated))


def weekday_from_sunday(c: Column) -> Column:
    return F.dayofweek(c) - F.lit(1)


def volume(length: Column, height: Column, width: Column) -> Column:
    return as_double(length) * as_double(height) * as_double(width)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(as_double(numerator), as_double(denominator))


def cents_to_currency(c: Column) -> Column:
    return as_double(c) / F.lit(100.0)


def surrogate_key(*parts: Column) -> Column:
    marker = F.lit(contract.KEY_NULL_MARKER)
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), marker) for p in parts]).cast("binary"))


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def calendar_months(start: Column, end: Column) -> Column:
    """Month number difference; the day of the month does not matter."""
    return (F.year(end) - F.year(start)) * F.lit(12) + (F.month(end) - F.month(start))


def predicted_class(probability: Column, threshold: float = contract.CLASS_THRESHOLD) -> Column:
    """0/1 by threshold; a missing probability, null or NaN, has no class."""
    return F.when(defined(probability), flag(probability >= F.lit(threshold)))


def band(score: Column, warning: float, alert: float) -> Column:
    return (
        F.when(score.isNull() | F.isnan(score), F.lit("unknown"))
        .when(score < F.lit(warning), F.lit("ok"))
        .when(score < F.lit(alert), F.lit("warning"))
        .otherwise(F.lit("alert"))
    )


def severity(status: Column) -> Column:
    """Rank for worst-of rollups; an unknown status does not raise the level."""
    return F.when(status == "alert", 2).when(status == "warning", 1).otherwise(0)


def severity_name(rank: Column) -> Column:
    return F.when(rank == 2, "alert").when(rank == 1, "warning").otherwise("ok")


def clipped_share(share: Column) -> Column:
    return F.greatest(F.least(share, F.lit(1.0)), F.lit(contract.PSI_FLOOR))


def defined(c: Column) -> Column:
    """True for a number that is neither null nor NaN."""
    return c.isNotNull() & ~F.isnan(c)
