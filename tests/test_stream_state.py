"""Stateful stream jobs equal batch results, and go on after a restart."""
import pytest
from pyspark.sql import functions as F

from rankforge.streaming import jobs as J

NOW = {"availableNow": True}
EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"


@pytest.fixture(scope="module")
def events(spark):
    base = F.timestamp_seconds(F.lit(1_700_000_000))
    return spark.range(400).select(
        F.col("id").alias("event_id"),
        (base + F.make_dt_interval(secs=(F.col("id") * 97 % 401 * 60).cast("decimal(18,6)")))
        .alias("ts"),
        (F.col("id") % 7 % 4).alias("user_id"),
        F.element_at(F.array(F.lit("view"), F.lit("click"), F.lit("error")),
                     (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 11).cast("double").alias("value"))


def test_running_profile_over_restarts(spark, events, tmp_path):
    """Every slice is a new run of the query: state comes from the checkpoint."""
    sink = J.replay(J.event_messages(events), f"{tmp_path}/src", 3,
                    lambda src: J.profile_state_job(spark, src, str(tmp_path), trigger=NOW))
    got = {r.event_id: r for r in spark.read.parquet(sink).collect()}
    assert len(got) == 400
    known = {}
    for e in sorted(events.collect(), key=lambda r: (r.ts, r.event_id)):
        us = int(e.ts.timestamp() * 1e6)
        n, total, last, begun = known.get(e.user_id, (0, 0.0, None, None))
        begun = us if last is None or us - last >= 1_800_000_000 else begun
        r = got[e.event_id]
        assert (r.n, r.value_sum) == (n + 1, total + e.value)
        assert r.since_last == (None if last is None else (us - last) / 1e6)
        assert r.session_seconds == (us - begun) / 1e6
        known[e.user_id] = (n + 1, total + e.value, us, begun)


def test_clicks_within_the_interval(spark, events, tmp_path):
    sink = J.replay(J.event_messages(events), f"{tmp_path}/src", 3,
                    lambda src: J.ctr_job(spark, src, str(tmp_path), trigger=NOW))
    got = sorted(((r.served_id, r.click_id) for r in spark.read.parquet(sink).collect()), key=str)
    rows = events.collect()
    views = [e for e in rows if e.event_type == "view"]
    clicks = [e for e in rows if e.event_type == "click"]
    mark = min(max(e.ts for e in views), max(e.ts for e in clicks)).timestamp() - 600
    want = []
    for v in views:
        hits = [c.event_id for c in clicks if c.user_id == v.user_id
                and 0 <= (c.ts - v.ts).total_seconds() <= 1800]
        want += [(v.event_id, c) for c in hits]
        if not hits and v.ts.timestamp() + 1800 < mark:
            want.append((v.event_id, None))
    assert got == sorted(want, key=str)
