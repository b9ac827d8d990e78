"""Clean web hits incrementally as they land, into the click table the batch job reads.

Same operators as the batch step (``pull_hits`` and ``explode_products``); the session
table is a static side of a stream-static left join. Rows are de-duplicated by a keyed merge
on write, not under a watermark: each micro-batch is made distinct and only rows that no
earlier batch wrote are added, however late they land. The table is stored by batch and event
day, and a batch is compared with the days that it has rows of, not with the whole history. A
batch that is run again replaces its own folder, so the output is the same after a failure.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketspark.operators.clicks import CLICK_COLUMNS, explode_products, pull_hits
from basketspark.operators.publish import read_if_exists

#: The day of clicks whose time stamp is null or no time.
NO_DAY = 0


def event_day() -> Column:
    """YYYYMMDD of the click's time stamp. It follows from a click column, so equal clicks have
    the same day (under one session time zone)."""
    day = F.date_format(F.col("time_stamp").try_cast("date"), "yyyyMMdd").cast("int")
    return F.coalesce(day, F.lit(NO_DAY)).alias("day")


def earlier_clicks(spark: SparkSession, out_path: str, batch_id: int, days: list[int]) -> DataFrame | None:
    """What earlier batches wrote of these days (other days' folders are not read), or None
    where nothing was written at all."""
    written = read_if_exists(spark, out_path)
    return written if written is None else written.where((F.col("batch") < batch_id) & F.col("day").isin(days))


def merge_clicks(rows: DataFrame, batch_id: int, out_path: str) -> None:
    """Write the rows of a batch that no earlier batch holds (nulls compare equal)."""
    own = f"{out_path}/batch={batch_id}"
    landed = rows.select(*CLICK_COLUMNS, event_day()).distinct().persist()
    try:
        days = sorted(r["day"] for r in landed.select("day").distinct().collect())  # calendar days
        if not days:
            landed.drop("day").write.mode("overwrite").parquet(f"{own}/day={NO_DAY}")  # keeps the columns' types
            return
        new, seen = landed, earlier_clicks(rows.sparkSession, out_path, batch_id, days)
        if seen is not None:
            seen = seen.select(*[F.col(c).alias(f"_{c}") for c in (*CLICK_COLUMNS, "day")])
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CLICK_COLUMNS]
            new = landed.join(seen, [F.col("day") == F.col("_day"), *same], "left_anti")
        # Rows of one day in few files; a day of very many rows is split.
        new.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(own)
    finally:
        landed.unpersist()


def start_clicks_stream(
    spark: SparkSession,
    source_path: str,
    source_schema,
    to_hits: Callable[[DataFrame], DataFrame],
    visit_sessions: DataFrame,
    window: tuple[int, int],
    out_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Read new parquet files of ``source_path`` and merge cleaned clicks into ``out_path``.

    ``to_hits`` maps the landed files to the hit columns (identity for a hit feed).
    """
    reader = spark.readStream.schema(source_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = explode_products(pull_hits(to_hits(reader.parquet(source_path)), visit_sessions, window), dedupe=False)
    writer = rows.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(
        lambda batch, batch_id: merge_clicks(batch, batch_id, out_path)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
