import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerting as al
from tidemark.operators.scoring import LexiconScorer
from tidemark.plans import fixtures as fx
from tidemark.schemas import POST
from tidemark.sources.store import SeenStore
from tidemark.streaming import jobs
from tidemark.streaming.alerts import alert_stream

from conftest import SMALL


def test_progress_is_kept(spark, scratch):
    src, out, ck = (f"{scratch}/{x}" for x in ("in", "out", "ck"))
    schema = "id bigint"
    for part in (range(3), range(3, 5)):
        spark.createDataFrame([(i,) for i in part], schema).write.mode("append").parquet(src)
        stream = jobs.read_files(spark, src, spark.createDataFrame([], schema).schema)
        jobs.run_available(stream, out, ck)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(5))


def test_dedup_across_runs(spark, scratch):
    src, out, ck = (f"{scratch}/{x}" for x in ("in", "out", "ck"))
    posts = fx.posts(spark, SMALL).select("post_id", "title", "content", "arrival_seq")
    for low, high in ((0, 120), (60, 200)):
        posts.filter(f"arrival_seq >= {low} and arrival_seq < {high}").write.mode("append") \
            .parquet(src)
        stream = jobs.stream_dedup(jobs.read_files(spark, src, posts.schema)).select("content_hash")
        jobs.run_available(stream, out, ck)
    got = [r.content_hash for r in spark.read.parquet(out).collect()]
    want = {r.content_hash for r in fx.posts_hashed(spark, SMALL).select("content_hash").collect()}
    assert len(got) == len(set(got)) and set(got) == want


def test_windows_equal_batch_and_late_rows_are_counted(spark, scratch):
    src, out, ck = (f"{scratch}/{x}" for x in ("in", "out", "ck"))
    schema = "ts timestamp_ntz, k string"

    def add(*stamps):
        spark.createDataFrame([(s,) for s in stamps], "s string").select(
            F.col("s").cast("timestamp_ntz").alias("ts"), F.lit("a").alias("k")) \
            .write.mode("append").parquet(src)

    def go():
        empty = spark.createDataFrame([], schema)
        counts = jobs.window_counts(jobs.read_files(spark, src, empty.schema), "ts", ["k"],
                                    "10 minutes", "5 minutes")
        return jobs.run_available(counts, out, ck)

    add("2024-01-01 00:01:00", "2024-01-01 00:02:00", "2024-01-01 00:07:00")
    go()
    add("2024-01-01 05:00:00")
    go()
    add("2024-01-01 00:03:00")
    last = go()
    assert jobs.late_rows(last) >= 1
    got = {(r.window.start.minute, r.n) for r in spark.read.parquet(out).collect()}
    assert got == {(55, 2), (0, 3), (5, 1)}
    batch = jobs.window_counts(spark.read.parquet(src).filter("ts <> '2024-01-01 00:03:00'"), "ts",
                               ["k"], "10 minutes", "5 minutes").filter("window.start < '2024-01-01 01:00'")
    assert {(r.window.start.minute, r.n) for r in batch.collect()} == got


def test_scored_batches_are_idempotent(spark, scratch):
    store = SeenStore(spark, f"{scratch}/store")
    write = jobs.score_and_store(store, f"{scratch}/out", LexiconScorer(fx.lexicon(spark)))
    posts = fx.posts(spark, SMALL)
    halves = [posts.filter("arrival_seq < 150"), posts.filter("arrival_seq >= 100")]
    for batch_id, half in enumerate(halves):
        write(half, batch_id)
    before = (spark.read.parquet(f"{scratch}/out").count(), store.read().count())
    write(halves[1], 1)
    assert (spark.read.parquet(f"{scratch}/out").count(), store.read().count()) == before
    distinct = fx.posts_hashed(spark, SMALL).select("content_hash").distinct().count()
    assert before == (distinct, distinct)


def test_a_stream_of_plain_posts(spark, scratch):
    store = SeenStore(spark, f"{scratch}/store")
    write = jobs.score_and_store(store, f"{scratch}/out", None)
    texts = ["a", "b", "a", "c", "b", "d"]
    for i, t in enumerate(texts):
        spark.createDataFrame([(str(i), t, "", 1, 100 + i, "B", "u", 0)], POST).coalesce(1) \
            .write.mode("append").parquet(f"{scratch}/in")
    stream = jobs.read_files(spark, f"{scratch}/in", POST, files_per_batch=1)
    jobs.each_available(stream, write, f"{scratch}/ck")
    out = spark.read.parquet(f"{scratch}/out")
    assert sorted(r.title for r in out.collect()) == ["a", "b", "c", "d"]
    assert out.select("run_id").distinct().count() == 4 and store.read().count() == 4


def test_alert_machine_equals_batch(spark, scratch):
    rnd = random.Random(5)
    points = [(k, t, rnd.random() < 0.85) for k in ("a", "b") for t in range(0, 6000, 60)]
    src, out, ck = (f"{scratch}/{x}" for x in ("in", "out", "ck"))
    schema = "alert string, t bigint, breach boolean"
    all_points = spark.createDataFrame(points, schema)
    for low in (0, 2000, 4000):
        all_points.filter(f"t >= {low} and t < {low + 2000}").write.mode("append").parquet(src)
        machine = alert_stream(jobs.read_files(spark, src, all_points.schema), 120, 60, 600)
        jobs.run_available(machine, out, ck)
    got = {(r.alert, r.t): (r.state, r.since, r.notify) for r in spark.read.parquet(out).collect()}
    states = al.hold_for(all_points, ["alert"], for_s=F.lit(120), step_s=60)
    firing = states.filter("state = 'firing'")
    sent = {(r.alert, r.t) for r in al.throttle(firing, ["alert"], F.lit(600)).collect()}
    want = {(r.alert, r.t): (r.state, r.since, (r.alert, r.t) in sent) for r in states.collect()}
    assert got == want


def machine_by_hand(points, step, repeat, no_data, end):
    """Rows of the alert machine, point by point."""
    out = {}
    for alert in {p[0] for p in points}:
        mine = sorted(p[1:] for p in points if p[0] == alert)
        since = sent = last = None
        for (t, breach, for_s, resolve), following in zip(mine, [*[p[0] for p in mine[1:]], None]):
            if breach and (since is None or t - last > step):
                since = t
            if not breach:
                since = None
            state = "ok" if since is None else "firing" if t - since >= for_s else "pending"
            notify = state == "firing" and (sent is None or t - sent >= repeat)
            sent = t if notify else sent
            out[alert, t, state] = (since, notify)
            limit = end if following is None else following
            if t + no_data < limit:
                out[alert, t + no_data, "NoData"] = (None, False)
            if resolve is not None and t + resolve < limit:
                out[alert, t + resolve, "resolved"] = (None, False)
                since = sent = None
            last = t
    return out


@pytest.mark.parametrize("cuts", [(0, 3000, 6000, 9000, 12000), (0, 7000), (0,)])
def test_alert_machine_by_event_time(spark, scratch, cuts):
    """Hold times by row, silence and resolution by timer, the same however the points are cut into runs."""
    rnd = random.Random(11)
    points = []
    for alert, for_s, resolve in (("a", 120, None), ("b", 0, 900), ("c", 600, 2000), ("d", 60, 700)):
        for t in range(60, 15000, 60):  # what is not after the epoch is late from the start
            quiet = 4000 < t < 5500 or (alert == "b" and t > 9000) or rnd.random() < 0.1
            if not quiet:
                points.append((alert, t, rnd.random() < 0.85, for_s, resolve))
    src, out, ck = (f"{scratch}/{x}" for x in ("in", "out", "ck"))
    rows = spark.createDataFrame(points, "alert string, t bigint, breach boolean, for_s bigint, resolve_s bigint")
    for low, high in zip(cuts, [*cuts[1:], 1 << 40]):
        rows.filter(f"t >= {low} and t < {high}").write.mode("append").parquet(src)
        machine = alert_stream(jobs.read_files(spark, src, rows.schema), None, 60, 600, 300, "10 minutes")
        jobs.run_available(machine, out, ck)
    rows = spark.read.parquet(out).collect()
    got = {(r.alert, r.t, r.state): (r.since, r.notify) for r in rows}
    assert len(got) == len(rows)
    last = max(p[1] for p in points)
    assert got == machine_by_hand(points, 60, 600, 300, last - 600)
