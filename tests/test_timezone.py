"""Results do not depend on the session time zone (the driver's session may not be UTC)."""

import pytest

from fieldlens.plans import queries as Q
from fieldlens.plans.models import drop_models

KEYS = ["window_scan", "upsert_merge", "incremental_scan", "stream_daily_counts", "null_sentinel_dates",
        "epoch_to_local", "match_intervals", "daily_dashboard"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("key", KEYS)
def test_same_result_in_other_session_zone(spark, root, key):
    f = Q.QUERIES[key]
    base = rows(f(spark, root))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    drop_models()
    try:
        other = rows(f(spark, root))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        drop_models()
    assert other == base
