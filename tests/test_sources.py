import hashlib
import os

from pyspark.sql import functions as F

from tidemark.operators import dedup, logs
from tidemark.schemas import POST, SCORED_POST
from tidemark.session import shared_dir, values_frame
from tidemark.sources import posts as src
from tidemark.sources import telemetry as tm
from tidemark.sources.store import SeenStore

ROWS = [("1", "a", "x", 5, 100, "Bitcoin", "u", 1), ("2", "b", None, 9, 200, "Bitcoin", "u", 2),
        ("3", "c", "z", 7, 300, " Bitcoin", "u", 3), ("4", "d", "w", 1, 400, "Bitcoin", "u", 4)]


def _posts(spark, rows=ROWS):
    return spark.createDataFrame(rows, POST)


def test_sample_posts_when_nothing_is_configured(spark):
    got = src.read_posts(spark)
    assert got.schema.names == POST.names
    assert [r.post_id for r in got.collect()] == ["dummy_1", "dummy_2"]


def test_read_has_the_fixed_schema(spark, scratch):
    _posts(spark).drop("url").write.parquet(scratch)
    got = src.read_posts(spark, scratch)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in POST]
    assert got.filter("url is not null").count() == 0 and got.count() == 4


def test_community_list_keeps_blanks(spark):
    assert src.community_list("a, b") == ["a", " b"]
    got = src.by_community(_posts(spark), src.community_list("Bitcoin,x"))
    assert sorted(r.post_id for r in got.collect()) == ["1", "2", "4"]


def test_hottest(spark):
    got = src.hottest(_posts(spark), limit=2).collect()
    assert {(r.subreddit, r.post_id, r["rank"]) for r in got} == {
        ("Bitcoin", "2", 1), ("Bitcoin", "1", 2), (" Bitcoin", "3", 1)}


def test_normalize(spark):
    df = _posts(spark).withColumn("created_utc", F.col("created_utc") + 0.9)
    got = {r.post_id: (r.content, r.created_utc, r.subreddit)
           for r in src.normalize_posts(df, F.lit("asked")).collect()}
    assert got["2"] == ("", 200, "asked") and got["1"] == ("x", 100, "asked")


def test_failing_source_is_counted_and_skipped(spark, scratch):
    _posts(spark).write.parquet(f"{scratch}/good")
    rows, errors = src.read_sources(spark, {"A": f"{scratch}/good", "B": f"{scratch}/missing"})
    assert rows.count() == 4 and {r.subreddit for r in rows.collect()} == {"A"}
    assert [tuple(r) for r in errors.collect()] == [("B", "fetch_failed", 1)]


def test_damaged_files_are_skipped_and_counted(spark, scratch):
    rows = spark.createDataFrame([("1", "t", "", 1, 1, "s", "u", 0), ("2", "t", "", 1, 1, "s", "u", 0)], POST)
    for part in (rows.limit(1), rows):
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/a")
    rows.coalesce(1).write.parquet(f"{scratch}/b")
    folder = f"{scratch}/a".replace("file:", "")
    with open(f"{folder}/part-damaged.parquet", "wb") as f:
        f.write(b"PAR1 no parquet at all PAR1")
    rows, errors = src.read_sources(spark, {"A": f"{scratch}/a", "B": f"{scratch}/b"})
    assert rows.count() == 5
    assert [tuple(r) for r in errors.collect()] == [("A", "file_failed", 1)]


def test_bad_lines_are_kept_apart(spark):
    lines = spark.createDataFrame([('{"post_id": "1", "score": 3}',), ('{"post_id": ',), ("",)],
                                  "line string")
    good, bad = src.quarantine(src.parse_lines(lines.filter("line <> ''"), "line", POST))
    assert [(r.post_id, r.score) for r in good.collect()] == [("1", 3)]
    assert [r._corrupt_record for r in bad.collect()] == ['{"post_id": ']


def test_csv_round_trip(spark, scratch):
    nasty = ['plain', 'two\nlines', 'quote " and , comma', '', '  spaced  ', '🚀\n\n"x"\r\ny',
             '\\', 'back\\"slash', '# hash', '""', "'", '\ttab\t']
    rows = [(str(i), t, t, i, i, "s", "u", i, "neutral", 0.5, 0.33, 0.33, 0.34, 0.5, "r")
            for i, t in enumerate(nasty)]
    df = spark.createDataFrame(rows, SCORED_POST)
    for _ in range(2):
        src.write_csv(df, scratch)
    got = sorted((tuple(r) for r in src.read_csv(spark, scratch).collect()), key=lambda r: int(r[0]))
    assert got == rows


def test_store_survives_and_repeats_add_nothing(spark, scratch):
    store = SeenStore(spark, scratch)
    assert store.read().count() == 0
    rows = dedup.store_rows(dedup.with_hash(_posts(spark)))
    store.commit(rows.filter("post_id in ('1', '2')"), "r1")
    store.commit(rows.filter("post_id = '3'"), "r2")
    store.commit(rows.filter("post_id = '3'"), "r2")
    again = SeenStore(spark, scratch)
    assert sorted(r.post_id for r in again.read().collect()) == ["1", "2", "3"]
    assert sorted(r.post_id for r in again.read(excluding="r2").collect()) == ["1", "2"]


def test_bucketed_store_is_not_shuffled(spark):
    import uuid

    store = SeenStore(spark, table=f"seen_{uuid.uuid4().hex}", buckets=4)
    rows = dedup.store_rows(dedup.with_hash(_posts(spark)))
    store.commit(rows.filter("post_id <> '4'"), "r1")
    store.commit(rows.filter("post_id = '4'"), "r2")
    store.commit(rows.filter("post_id = '4'"), "r2")
    assert store.read().count() == 4
    batch = dedup.with_hash(_posts(spark))
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.enabled")}
    try:
        for key, value in zip(held, ("-1", "false")):
            spark.conf.set(key, value)
        joined = dedup.dedup_against(batch, store.read())
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert joined.count() == 0
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
        spark.sql(f"DROP TABLE {store.table}")


def test_logs(spark, scratch):
    lines = ["2024-01-01 00:00:07 - app.main - ERROR - it - broke", "Traceback: x",
             "2024-01-01 00:00:08,123 - a.b - INFO - ok"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(scratch)
    got = {r.message: (r.asctime, r.name, r.levelname)
           for r in tm.read_text_logs(spark, scratch).collect()}
    assert got == {"it - broke": ("2024-01-01 00:00:07", "app.main", "ERROR"),
                   "Traceback: x": (None, None, None), "ok": ("2024-01-01 00:00:08", "a.b", "INFO")}


def test_json_logs_and_status(spark, scratch):
    df = values_frame(spark, "levelname string, message string", [("ERROR", "x")])
    tm.write_status(df, scratch)
    tm.write_status(df, scratch)
    assert [(r.levelname, r.message, r.lineno) for r in tm.read_json_logs(spark, scratch).collect()] \
        == [("ERROR", "x", None)]


def test_log_tail(spark):
    df = spark.range(3000).select(
        F.col("id").alias("seq"), F.col("id").alias("t"),
        F.when(F.col("id") % 100 == 0, "an error").otherwise("fine").alias("line"))
    r = logs.log_tail_health(df, "t", "seq", 3000).first()
    assert (r.errors, r.last_t, r.stale, r.healthy) == (10, 2999, False, True)
    r = logs.log_tail_health(df, "t", "seq", 3000 + 4 * 3600).first()
    assert r.stale and not r.healthy
    assert logs.log_tail_health(df.limit(0), "t", "seq", 0).first().healthy is False


def test_manifest(spark, scratch):
    spark.range(1000).repartition(3).write.parquet(scratch)
    whole = {r.path: r.checksum for r in tm.file_manifest(spark, scratch, "*.parquet").collect()}
    assert len(whole) == 3
    for path, checksum in whole.items():
        with open(path.replace("file:", "").replace("//", "/"), "rb") as f:
            assert hashlib.md5(f.read()).hexdigest() == checksum


def test_shared_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    assert os.sep in shared_dir(spark)


def test_large_files_are_listed_without_being_opened(spark, scratch):
    """A file of 3 GiB, sparse on disk."""
    import os

    folder = scratch.removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/small", "wb") as f:
        f.write(b"abc")
    with open(f"{folder}/large", "wb") as f:
        f.truncate(3 << 30)
    got = {os.path.basename(r.path): (r.length, r.checksum) for r in tm.file_manifest(spark, scratch).collect()}
    assert got == {"small": (3, "900150983cd24fb0d6963f7d28e17f72"), "large": (3 << 30, None)}


def test_a_file_is_streamed_through_its_checksum(spark, scratch):
    """Names with odd signs, and a file larger than a value of Spark, sparse on disk."""
    import os

    folder, size = scratch.removeprefix("file:"), (1 << 31) + 5
    os.makedirs(folder)
    for name in ("a b%20é#?+", "packed.gz"):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(name.encode() * 9)
    with open(f"{folder}/large", "wb") as f:
        f.write(b"start")
        f.truncate(size)
    expected = hashlib.md5(b"start")
    for n in [1 << 20] * (1 << 11):
        expected.update(bytes(n))
    files = tm.file_manifest(spark, scratch, checked_bytes=None)
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    got = {os.path.basename(r.path): (r.length, r.checksum) for r in files.filter("checksum > ''").collect()}
    assert got.pop("large") == (size, expected.hexdigest())
    assert got == {n: (9 * len(n.encode()), hashlib.md5(n.encode() * 9).hexdigest()) for n in ("a b%20é#?+", "packed.gz")}


def test_scrape_files_with_types_and_times(spark, scratch):
    import os
    import time

    folder = scratch.removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/a.prom", "w") as f:
        f.write('# HELP x text\n# TYPE x counter\nx{k="v"} 3 1700000000999\nx 4\n# TYPE h histogram\n'
                'h_bucket{le="+Inf"} 2\nh_count 2\n# TYPE s summary\ns_sum 1.5 -1\nfree 7\nnot a line at all\n')
    got = {r.metric: r for r in tm.with_types(
        tm.read_exposition(spark, scratch), tm.metric_types(tm.scrape_lines(spark.read.text(scratch)))).filter("size(labels) = 0 OR metric <> 'x'").collect()}
    assert {m: r.type for m, r in got.items()} == {"x": "counter", "h_bucket": "histogram", "h_count": "histogram",
                                                   "s_sum": "summary", "free": "untyped"}
    assert abs(got["x"].t - time.time()) < 600 and got["s_sum"].t == -1 and got["h_bucket"].labels == {"le": "+Inf"}
    stamped = tm.read_exposition(spark, scratch).filter("size(labels) = 1 AND metric = 'x'").first()
    assert (stamped.t, stamped.value) == (1700000000, 3.0)
