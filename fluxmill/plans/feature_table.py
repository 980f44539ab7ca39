"""The 30-column feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxmill.functions import features as X
from fluxmill.operators.imputation import as_scalar, cast_users, fill_columns, scale_columns
from fluxmill.operators.profiles import fit_profile, profile_rows, profile_stats, with_region_averages
from fluxmill.schemas import FEATURE_COLUMNS

# About 64 MB of shuffled features.
ROWS_PER_PARTITION = 500_000


def dealt_partitions(partitions: int, rows: int) -> int:
    """`partitions`, or more where one of them would get over ROWS_PER_PARTITION rows."""
    return max(partitions, -(-rows // ROWS_PER_PARTITION))


def transform(
    users: DataFrame, profile: DataFrame, partitions: int | None = None, rows: int | None = None
) -> DataFrame:
    """Features of each row, given a fitted profile.

    One narrow stage: scan, lookup in the profile, one projection per layer. `partitions` adds a
    round-robin shuffle of the output and is left out unless the file count matters; it is the least
    number, see dealt_partitions. `rows` is how many users there are, which are counted for it otherwise.
    """
    stats = as_scalar(profile_stats(profile))
    typed = cast_users(users)
    filled = typed.withColumns(fill_columns(stats))
    featured = with_region_averages(filled.select("*", *X.row_local()), profile)
    scaled = featured.withColumns({**scale_columns(stats), "income_x_pageviews": X.interaction()})
    result = scaled.select(*FEATURE_COLUMNS)
    if not partitions:
        return result
    return result.repartition(dealt_partitions(partitions, users.count() if rows is None else rows))


def feature_table(users: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fit on and transform the same table: two scans, no shuffle of the rows."""
    profile = fit_profile(cast_users(users))
    return transform(users, profile, partitions, profile_rows(profile) if partitions else None)
