"""The request-to-call match (J1) on streams of clicks and call records.

Batch runs (``plans.call_facts.request_match``) recompute a day at a time;
here the same match is a Structured Streaming stream-stream inner join:
equality on (user, target) plus the time range ``click <= call start <
click + gap`` on event-time columns.  Output rows are the same as the batch
operator's in whatever order and batches the records arrive (append mode,
exactly-once file sink with a checkpoint in the shared folder).

Without ``lateness_s`` nothing is dropped and the join keeps its state.  A
caller who can vouch for a largest lateness names it; the watermark then
evicts state, and records later than that are not matched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.call_facts import REQUEST_CALL_VIDEO, tag_request, with_call_start


def match_stream(req: DataFrame, video: DataFrame, gap_s: int,
                 lateness_s: int | None = None) -> DataFrame:
    """Stream-stream join of tagged clicks and per-minute calls.

    Times compare at whole seconds (as the batch operator): the click time is
    truncated to the second; call starts are whole seconds already.
    ``lateness_s``: how late a record may arrive (watermark delay); None: any.
    """
    def late(df: DataFrame, col: str) -> DataFrame:
        return df if lateness_s is None else df.withWatermark(col, f"{lateness_s} seconds")

    clicks = (late(tag_request(req).withColumn("click_sec", F.date_trunc("second", F.col("create_time"))
                                               .cast("timestamp")), "click_sec")
              .select(F.col("user_id").alias("r_user_id"), F.col("target_user_id").alias("r_target"),
                      "click_sec", "channel_name", "label"))
    calls = (late(with_call_start(video.filter(F.col("goddess_video") == REQUEST_CALL_VIDEO))
                  .withColumn("start_ts", F.col("start_time").cast("timestamp")), "start_ts")
             .select("user_id", "matched_id", "room_id", "start_ts", "start_time",
                     F.col("create_time").alias("end_time"), "video_time"))
    cond = ((clicks.r_user_id == calls.user_id) & (clicks.r_target == calls.matched_id)
            & (calls.start_ts >= clicks.click_sec)
            & (calls.start_ts < clicks.click_sec + F.expr(f"INTERVAL {int(gap_s)} SECONDS")))
    m = clicks.join(calls, cond, "inner")
    return m.select(F.col("r_user_id").alias("user_id"), F.col("r_target").alias("target_user_id"),
                    "room_id", F.col("start_time").alias("create_time"), "end_time", "video_time",
                    "channel_name", F.col("label").cast("int").alias("label"))


def run_available(spark: SparkSession, stream: DataFrame, out_path: str,
                  checkpoint: str) -> DataFrame:
    """Process everything available now (``availableNow`` trigger) into a
    parquet sink, then return the sink as a batch frame."""
    q = (stream.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
