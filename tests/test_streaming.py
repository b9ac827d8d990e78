"""The click-cleaning stream over files landing in two micro-batches equals the batch step."""

from pyspark.sql import functions as F

from basketspark.operators import clicks
from basketspark.plans.catalog import fixture_config
from basketspark.runtime import scratch_path
from basketspark.sources.fixtures import hits_view, read_testdata, visit_sessions_view
from basketspark.streaming import earlier_clicks, merge_clicks, start_clicks_stream


def test_stream_two_batches_with_duplicates(spark, sf_small):
    lineitem = read_testdata(spark, sf_small, "lineitem")
    sessions = visit_sessions_view(read_testdata(spark, sf_small, "orders"))
    window = fixture_config().window
    landing = scratch_path(spark, "landing")
    # Two files: open (newest) lines, then all lines, older ones and the same hits again.
    lineitem.where(F.col("l_linestatus") == "O").coalesce(1).write.parquet(f"{landing}/part1")
    lineitem.coalesce(1).write.parquet(f"{landing}/part2")
    files = sorted(
        r.path for r in spark.read.format("binaryFile").load(f"{landing}/part*/*.parquet").select("path").collect()
    )
    assert len(files) == 2
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    query = start_clicks_stream(
        spark,
        landing + "/part*",
        lineitem.schema,
        hits_view,
        sessions,
        window,
        out,
        ckpt,
        max_files_per_trigger=1,
    )
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 2
    streamed = spark.read.parquet(out)
    batch = clicks.parse_hits(hits_view(lineitem), sessions, window)
    rows = lambda df: sorted((tuple(r) for r in df.select(*clicks.CLICK_COLUMNS).collect()), key=repr)
    assert rows(streamed) == rows(batch)


def _clicks(spark, *rows):
    schema = "session_key int, visit_id string, visit_number int, time_stamp string, account_no string, prod_id string"
    return spark.createDataFrame([(1, "v", 1, at, "a", prod) for at, prod in rows], schema)


def test_merge_by_event_day(spark):
    out = scratch_path(spark, "merged")
    batches = [
        [],  # nothing landed yet
        [("2024-05-01 10:00:00", "P"), ("2024-05-02 10:00:00", "P"), (None, "P"), ("soon", "P")],
        # late, again, and new rows; null and unreadable time stamps are told apart, too
        [("2024-05-01 10:00:00", "P"), ("2024-05-01 10:00:00", "Q"), ("2024-05-03 00:00:00", None), (None, "P"), ("soon", "P"), ("later", "P")],
        [],
        [("2024-05-03 00:00:00", None), ("2024-05-03 00:00:00", "P")],
    ]
    for number, rows in enumerate(batches):
        merge_clicks(_clicks(spark, *rows), number, out)
    merge_clicks(_clicks(spark, *batches[2]), 2, out)  # run again after a failure
    found = sorted(((r.time_stamp, r.prod_id) for r in spark.read.parquet(out).collect()), key=repr)
    assert found == sorted({row for rows in batches for row in rows}, key=repr)
    per_batch = {r["batch"]: r["count"] for r in spark.read.parquet(out).groupBy("batch").count().collect()}
    assert per_batch == {1: 4, 2: 3, 4: 1}


def test_only_the_days_of_a_batch_are_read(spark):
    out = scratch_path(spark, "merged-days")
    merge_clicks(_clicks(spark, ("2024-05-01 10:00:00", "P"), ("2024-05-02 10:00:00", "P")), 0, out)
    seen = earlier_clicks(spark, out, 1, [20240502])
    plan = seen._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "20240502" in filters and "batch" in filters
    assert [r.time_stamp for r in seen.collect()] == ["2024-05-02 10:00:00"]
