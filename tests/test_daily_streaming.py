"""The one-run-per-day orchestration and the streaming match."""
import dataclasses
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from rfmlens.plans.daily import FIXTURE_RUN, PUBLISHED, run_day
from rfmlens.sources import sinks as K
from rfmlens.sources.publish import read_published
from rfmlens.sources.schemas import DAY_SCHEMAS

SF = "/root/testdata/sf0.001"


def _same(a, b):
    cols = sorted(a.columns)
    return sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))


def test_daily_run_writes_every_table_idempotently(spark):
    root = tempfile.mkdtemp(prefix="rfmlens-daily-")
    # without the 3-day user window, as the preference keys
    run = dataclasses.replace(FIXTURE_RUN, user_days=None)
    first = run_day(spark, SF, run, out_root=root)
    assert set(first) == set(DAY_SCHEMAS) and len(first) == 53
    day = [run.day]
    lv = read_published(spark, root, "streamer_level_detail", day).drop("dt")
    n = lv.count()
    run_day(spark, SF, run, out_root=root, tables=["streamer_level_detail", "country_recall_percentage"])
    # re-read: the newest commit counts, the rewrite replaced the day's files
    lv = read_published(spark, root, "streamer_level_detail", day).drop("dt")
    assert lv.count() == n
    assert _same(lv, E.queries()["job_streamer_level"](spark, SF))
    for wide, served in PUBLISHED.items():
        w = read_published(spark, root, wide, day)
        for name, cols in served.items():
            assert _same(read_published(spark, root, name, day).drop("dt"), w.select(*cols).distinct())
    for name in set(first) - set(PUBLISHED) - {n for s in PUBLISHED.values() for n in s}:
        got = K.read_days(spark, f"{root}/{name}", day, schema=DAY_SCHEMAS[name]).drop("dt")
        assert got.schema.simpleString() == DAY_SCHEMAS[name].simpleString()
    top = K.read_days(spark, f"{root}/country_recall_percentage", day).drop("dt")
    assert _same(top, E.queries()["job_country_recall"](spark, SF))


def test_streaming_match_equals_batch(spark):
    s = E.queries()["request_match_stream"](spark, SF)
    b = E.queries()["request_match_join"](spark, SF)
    assert s.count() == b.count() > 0
    assert _same(s, b)
    assert s.filter(F.col("create_time") <= F.col("end_time")).count() == s.count()


def test_streaming_match_in_six_batches_out_of_order(spark, tmp_path):
    from rfmlens.sources.fixtures import FIXTURE_GAP_S, request_record_from, video_record_from
    from rfmlens.streaming.request_match import match_stream, run_available
    sf = "/root/testdata/sf0.01"
    want = E.queries()["request_match_join"](spark, sf)
    events = spark.read.parquet(f"{sf}/events.parquet")
    part = F.pmod(F.xxhash64(F.col("event_id")), F.lit(6))
    events.repartition(6, part).write.option("maxRecordsPerFile", 0).parquet(str(tmp_path / "events"))
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
              .parquet(str(tmp_path / "events")))
    m = match_stream(request_record_from(stream), video_record_from(stream), FIXTURE_GAP_S)
    got = run_available(spark, m, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert got.count() == want.count() == 221
    assert _same(got.select(*want.columns), want)
