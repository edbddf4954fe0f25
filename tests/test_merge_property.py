"""The guarded merge equals applying the incoming rows one by one, in batch
order, with "replace if incoming processed_at >= stored" (the serving store's
upsert rule)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odometer.operators.serving import upsert_utilization

T0 = dt.datetime(2024, 1, 1)
SCHEMA = (
    "window_start timestamp_ntz, window_end timestamp_ntz, zone string, telemetry_event_count long, "
    "spark_batch_id long, processed_at timestamp_ntz"
)

rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 1000)), min_size=0, max_size=8
)


def _df(spark, items, batch_of):
    data = [
        (T0, T0 + dt.timedelta(minutes=5), zone, value, batch_of(i), T0 + dt.timedelta(seconds=sec))
        for i, (zone, sec, value) in enumerate(items)
    ]
    df = spark.createDataFrame(data, SCHEMA)
    for c in ("window_start", "window_end", "processed_at"):
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(stored=rows, incoming=rows)
def test_guarded_merge_matches_sequential_upsert(spark, stored, incoming):
    # one stored row per key (a primary key), incoming applied in batch order
    target_items = list({z: (z, s, v) for z, s, v in stored}.values())
    target = _df(spark, target_items, lambda i: 0)
    batch = _df(spark, incoming, lambda i: i + 1)
    model = {z: (s, v) for z, s, v in target_items}
    for z, s, v in incoming:
        if z not in model or s >= model[z][0]:
            model[z] = (s, v)
    got = {
        r["zone"]: (int((r["processed_at"] - T0).total_seconds()), r["telemetry_event_count"])
        for r in upsert_utilization(target, batch)
        .select("zone", F.col("processed_at").cast("timestamp_ntz").alias("processed_at"), "telemetry_event_count")
        .collect()
    }
    assert got == model
