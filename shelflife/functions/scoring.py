"""Retention rules.

There are two overdue rules on purpose.  The inventory compares timestamps
(``as_of > reference + days``), the readiness report compares calendar days
(``days > retention``); an item modified ten days and one hour ago under a
ten-day policy is overdue in the first and within retention in the second.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.functions import fixed, times


def retention_days(item_type: Column, policy: dict[str, int] | None, default_days: int) -> Column:
    """Days for a type from a policy mapping; types it does not list get the default.

    Without a mapping only the types that differ by rule are listed, so the default
    reaches all others.
    """
    mapping = fixed.RETENTION_DAYS if policy is None else policy
    if not mapping:
        return F.lit(default_days)
    entries = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(F.try_element_at(entries, item_type), F.lit(default_days))


def score(
    rows: DataFrame,
    as_of: datetime,
    policy: dict[str, int] | None = None,
    default_days: int = fixed.DEFAULT_RETENTION_DAYS,
) -> DataFrame:
    """Turn ``created_ts`` and ``modified_ts`` into dates, age, due date and overdue flag."""
    reference = F.coalesce("modified_ts", "created_ts")
    days = retention_days(F.col("item_type"), policy, default_days)
    due = times.plus_days(reference, F.col("retention_period_days"))
    return rows.withColumn("retention_period_days", days).withColumns(
        {
            "created_date": F.to_date("created_ts"),
            "last_modified_date": F.to_date("modified_ts"),
            "age_days": times.whole_days_between(reference, times.at(as_of)),
            "deletion_due_date": F.to_date(due),
            "is_overdue": times.at(as_of) > due,
            "scan_date": times.on(as_of),
        }
    )


def readiness_columns(rows: DataFrame, as_of: datetime) -> DataFrame:
    """Best available date, its provenance, and the verdict by calendar days.

    Expects ``act_date_by_id``, ``act_date_by_name``, ``inventory_modified_date``,
    ``created_date`` and ``retention_days``.  A dated item without a retention
    period is labelled within retention although ``exceeds_retention`` is null.
    """
    return verdict_columns(best_date(rows), as_of)


def best_date(rows: DataFrame) -> DataFrame:
    """``last_modified_date`` from the first source that has one, and ``date_source``."""
    sources = [
        ("act_date_by_id", fixed.SOURCE_ID_MATCH),
        ("act_date_by_name", fixed.SOURCE_NAME_MATCH),
        ("inventory_modified_date", fixed.SOURCE_INVENTORY),
        ("created_date", fixed.SOURCE_CREATED),
    ]
    provenance = F.coalesce(
        *[F.when(F.col(name).isNotNull(), F.lit(label)) for name, label in sources],
        F.lit(fixed.SOURCE_NONE),
    )
    return rows.withColumns(
        {"last_modified_date": F.coalesce(*[name for name, _ in sources]), "date_source": provenance}
    )


def verdict_columns(dated: DataFrame, as_of: datetime) -> DataFrame:
    """Days, verdict and status of rows with their best date and ``retention_days``."""
    measured = dated.withColumn(
        "days_since_modified", F.datediff(times.on(as_of), F.col("last_modified_date"))
    )
    flagged = with_verdict(measured)
    over = F.col("days_since_modified") - F.col("retention_days")
    return flagged.withColumns(
        {
            "days_overdue": F.when(F.col("exceeds_retention"), over).otherwise(F.lit(0)),
            "status": status(F.col("last_modified_date"), F.col("exceeds_retention")),
        }
    )


def with_verdict(rows: DataFrame) -> DataFrame:
    """``exceeds_retention`` by calendar days; null where a date or a period is missing."""
    exceeds = F.col("days_since_modified") > F.col("retention_days")
    return rows.withColumn("exceeds_retention", exceeds)


def status(reference_date: Column, exceeds: Column) -> Column:
    return (
        F.when(reference_date.isNull(), fixed.STATUS_NO_DATE)
        .when(exceeds, fixed.STATUS_EXCEEDS)
        .otherwise(fixed.STATUS_WITHIN)
    )
