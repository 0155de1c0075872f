import pytest
from pyspark.sql import functions as F

from tidemark.operators.scoring import LexiconScorer
from tidemark.plans.batch import RunConfig, run
from tidemark.schemas import POST, SCORED_COLUMNS
from tidemark.session import values_frame
from tidemark.sources.posts import read_csv
from tidemark.sources.store import SeenStore

ROWS = [("1", "good", "day", 5, 100, "B", "u", 1), ("2", "bad", "", 9, 200, "B", "u", 2),
        ("3", "good", "day", 7, 300, "E", "u", 3), ("4", "x", None, 1, 400, "E", "u", 4)]


def _config(spark, base, rows=ROWS, **more):
    words = values_frame(spark, "token string, polarity int", [("good", 1), ("bad", -1)])
    return RunConfig(sink=f"{base}/out", store=SeenStore(spark, f"{base}/store"),
                     posts=spark.createDataFrame(rows, POST), scorer=LexiconScorer(words), **more)


def test_run(spark, scratch):
    r = run(spark, _config(spark, scratch, run_id="r1", communities=["B", "E"],
                           csv=f"{scratch}/csv"))
    assert (r.fetched, r.unique, r.duplicates, r.processed, r.reason) == (4, 3, 1, 3, None)
    assert r.labels == {"positive": 1, "negative": 1, "neutral": 1}
    out = spark.read.parquet(f"{scratch}/out")
    assert out.columns == SCORED_COLUMNS
    assert {x.post_id: x.sentiment_label for x in out.collect()} == {
        "1": "positive", "2": "negative", "4": "neutral"}
    assert read_csv(spark, f"{scratch}/csv").count() == 3
    assert out.filter(F.col("sentiment_score") != F.col("sentiment_confidence")).count() == 0


def test_second_run_finds_nothing_new_and_repeats_are_idempotent(spark, scratch):
    first = run(spark, _config(spark, scratch, run_id="r1"))
    again = run(spark, _config(spark, scratch, run_id="r1"))
    assert (first.unique, first.labels) == (again.unique, again.labels)
    assert spark.read.parquet(f"{scratch}/out").count() == 3
    assert SeenStore(spark, f"{scratch}/store").read().count() == 3
    second = run(spark, _config(spark, scratch, run_id="r2"))
    assert (second.unique, second.duplicates, second.reason) == (0, 4, "no_unique_posts")
    assert spark.read.parquet(f"{scratch}/out").count() == 3
    extra = ROWS + [("9", "new", "good", 1, 900, "B", "u", 0)]
    third = run(spark, _config(spark, scratch, extra, run_id="r3"))
    assert (third.unique, third.duplicates) == (1, 4)


def test_nothing_fetched_writes_nothing(spark, scratch):
    r = run(spark, _config(spark, scratch, communities=["none"]))
    assert r.reason == "no_posts_fetched"
    with pytest.raises(Exception):
        spark.read.parquet(f"{scratch}/out").count()


def test_limit_per_community(spark, scratch):
    r = run(spark, _config(spark, scratch, communities=["E", "B"], limit=1))
    assert (r.fetched, r.unique) == (2, 2)
    assert {x.post_id for x in spark.read.parquet(f"{scratch}/out").collect()} == {"2", "3"}


def test_no_scorer(spark, scratch):
    config = _config(spark, scratch)
    config.scorer = None
    assert run(spark, config).labels == {"neutral": 3}


def test_strict_emits_an_edited_post_each_time(spark, scratch):
    edited = [("1", "old", "", 1, 100, "B", "u", 0), ("1", "new", "", 1, 200, "B", "u", 0)]
    for run_id in ("r1", "r2"):
        r = run(spark, _config(spark, scratch, edited, run_id=run_id, strict=True))
        assert r.unique == (2 if run_id == "r1" else 1)
    assert SeenStore(spark, f"{scratch}/store").read().count() == 1


def test_bad_sink_fails_the_run(spark, scratch):
    config = _config(spark, scratch)
    config.sink = "nosuchscheme://x/out"
    with pytest.raises(Exception):
        run(spark, config)
    assert SeenStore(spark, f"{scratch}/store").read().count() == 0


def test_metrics_of_runs_add_up(spark, scratch):
    from tidemark.plans.batch import RunResult
    from tidemark.plans.run_metrics import counter_totals, fetched_samples, run_samples
    from tidemark.sources.telemetry import exposition_lines

    posts = spark.createDataFrame([("A",)] * 50 + [("B",)] * 30, "subreddit string")
    runs = [RunResult("1", None, 50, 40, 10, 40, {"positive": 15, "neutral": 25}, 12.0),
            RunResult("2", None, 30, 25, 5, 25, {"positive": 10, "negative": 10, "neutral": 5}, 45.0),
            RunResult("3", "no_unique_posts")]
    samples = fetched_samples(posts)
    for r in runs:
        samples = samples.unionByName(run_samples(spark, r, 1.0))
    counters = counter_totals(samples.filter("metric <> 'pipeline_status'"))
    lines = {r[0] for r in exposition_lines(counters).collect()}
    assert {'reddit_posts_fetched_total{subreddit="A"} 50.0',
            'reddit_posts_fetched_total{subreddit="B"} 30.0',
            'reddit_posts_deduplicated_total 15.0', 'reddit_posts_processed_total 65.0',
            'sentiment_distribution_total{label="positive"} 25.0',
            'sentiment_distribution_total{label="negative"} 10.0',
            'sentiment_distribution_total{label="neutral"} 30.0',
            'pipeline_errors_total{component="pipeline",error_type="no_unique_posts"} 1.0',
            'pipeline_total_duration_seconds_bucket{le="30.0"} 1.0',
            'pipeline_total_duration_seconds_bucket{le="60.0"} 2.0',
            'pipeline_total_duration_seconds_count 2.0'} <= lines


def test_statuses_of_runs(spark):
    from tidemark.plans.batch import RunResult
    from tidemark.plans.run_metrics import run_samples

    for reason, want in ((None, 1.0), ("no_posts_fetched", 0.0)):
        got = run_samples(spark, RunResult("1", reason)).filter("metric = 'pipeline_status'")
        assert got.first().value == want


def test_store_keeps_the_version_that_arrived_first(spark, scratch):
    """An edited post whose newer version has the earlier rank."""
    rows = [("7", "old", "text", 1, 100, "B", "u", 1), ("7", "new", "text", 9, 100, "B", "u", 1)]
    config = _config(spark, scratch, rows, run_id="r1", communities=["B"], limit=5)
    run(spark, config)
    stored = SeenStore(spark, f"{scratch}/store").read().collect()
    assert [(r.post_id, r.title) for r in stored] == [("7", "new")]
