import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators import timeseries as ts
from tidemark.sources import telemetry as tm

INF = float("inf")


def _samples(spark, seed, resets=True):
    rnd = random.Random(seed)
    rows = []
    for s in ("a", "b"):
        value = 0.0
        for t in sorted(rnd.sample(range(0, 20000), 300)):
            value = 0.0 if resets and rnd.random() < 0.03 else value + rnd.randint(0, 4)
            rows.append((s, t, value))
    return rows, spark.createDataFrame(rows, "s string, t bigint, value double")


def _deltas(rows, s):
    line = sorted((t, v) for k, t, v in rows if k == s)
    out = []
    for i, (t, v) in enumerate(line):
        before = line[i - 1][1] if i else None
        out.append((t, 0.0 if before is None else v if v < before else v - before))
    return out


@pytest.mark.parametrize("window_s", [60, 900, 14400])
def test_increase_by_brute_force(spark, window_s):
    rows, df = _samples(spark, window_s)
    for r in ts.counter_increase(df, ["s"], window_s).collect():
        want = sum(d for t, d in _deltas(rows, r.s) if r.t - window_s < t <= r.t)
        assert r.increase == want
    rate = ts.counter_rate(df, ["s"], window_s).filter("t > 5000").first()
    assert rate.rate >= 0


def test_increase_on_grid_shows_silence(spark):
    rows, df = _samples(spark, 5)
    got = ts.increase_on_grid(df, ["s"], 600, 0, 30000, 150).collect()
    assert len(got) == 2 * 201
    for r in got:
        assert r.increase == sum(d for t, d in _deltas(rows, r.s) if r.t - 600 < t <= r.t), r
    quiet = ts.no_activity(ts.increase_on_grid(df, ["s"], 600, 0, 30000, 150))
    assert quiet.filter("t >= 21000").count() == 2 * 61


@pytest.mark.parametrize("start", [0, 7])
def test_asof_by_brute_force(spark, start):
    rows, df = _samples(spark, 9)
    got = {(r.s, r.t): r.value for r in ts.asof_grid(df, ["s"], start, 20000, 15, 120).collect()}
    want = {}
    for s in "ab":
        line = sorted((t, v) for k, t, v in rows if k == s)
        for g in range(start, 20001, 15):
            seen = [v for t, v in line if g - 120 < t <= g]
            if seen:
                want[s, g] = seen[-1]
    assert got == want


def test_quantile(spark):
    rows = [("x", 1.0, 10), ("x", 2.0, 20), ("x", 4.0, 40), ("x", INF, 40),
            ("tail", 1.0, 0), ("tail", 2.0, 1), ("tail", INF, 100), ("none", 1.0, 0), ("none", INF, 0)]
    df = spark.createDataFrame(rows, "k string, le double, cumulative bigint")
    got = {r.k: r.quantile for r in ts.histogram_quantile(df, 0.5, ["k"]).collect()}
    assert got == {"x": 2.0, "tail": 2.0}
    assert ts.histogram_quantile(df, 0.75, ["k"]).filter("k = 'x'").first().quantile == 3.0


def test_histogram_buckets(spark):
    df = spark.createDataFrame([("a", v) for v in (0.05, 0.1, 0.7, 99.0)], "k string, v double")
    bounds = agg.BUCKETS["sentiment_analysis_duration_seconds"]
    got = {r.le: r.cumulative for r in agg.histogram_buckets(df, "v", bounds, ["k"]).collect()}
    assert got[0.1] == 2 and got[0.5] == 2 and got[1.0] == 3 and got[60.0] == 3 and got[INF] == 4
    totals = agg.histogram_totals(df, "v", ["k"])
    assert tuple(totals.first()) == ("a", 99.85, 4, 24.9625)
    lines = {r[0] for r in tm.exposition_lines(tm.histogram_samples(
        agg.histogram_buckets(df, "v", bounds, ["k"]), totals, "d", ["k"])).collect()}
    assert {'d_bucket{k="a",le="0.1"} 2.0', 'd_bucket{k="a",le="+Inf"} 4.0', 'd_sum{k="a"} 99.85',
            'd_count{k="a"} 4.0'} <= lines


def test_ratio_aggregates_to_shared_keys(spark):
    num = spark.createDataFrame([("a", "x", 1, 2.0), ("a", "y", 1, 4.0)],
                                "i string, kind string, t int, v double")
    den = spark.createDataFrame([("a", 1, 12.0), ("b", 1, 0.0)], "i string, t int, v double")
    got = ts.ratio(num, den, ["i", "t"], "v", scale=100.0).collect()
    assert [tuple(r) for r in got] == [("a", 1, 50.0)]
    zero = spark.createDataFrame([("b", 1, 3.0)], "i string, t int, v double")
    assert ts.ratio(zero, den, ["i", "t"], "v").first().ratio is None


def test_exposition_round_trip(spark):
    rows = [("m_total", {"a": 'q"\\n\\', "b": "x,y}"}, 1.5), ("plain", {}, 3.0),
            ("big", {"l": "line\nbreak"}, 2.5e7), ("inf", {"le": "+Inf"}, INF)]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, value double")
    lines = tm.exposition_lines(df)
    noise = spark.createDataFrame([("# HELP m_total text",), ("",), ("bad line here x",)],
                                  "line string")
    back = tm.parse_exposition(lines.unionByName(noise)).collect()
    assert sorted((r.metric, sorted(r.labels.items()), r.value) for r in back) == sorted(
        (m, sorted(x.items()), v) for m, x, v in rows)


def test_counts_of_a_run(spark):
    rows = [(i, i % 5 == 0, ["positive", "negative", "neutral"][i % 3]) for i in range(80)]
    df = spark.createDataFrame(rows, "i int, is_duplicate boolean, sentiment_label string")
    r = agg.run_summary(df).first()
    assert (r.fetched, r.duplicates, r.unique, r.processed, r.reason) == (80, 16, 64, 64, None)
    assert r.positive + r.negative + r.neutral == 64
    assert agg.run_summary(df.limit(0)).first().reason == "no_posts_fetched"
    assert agg.run_summary(df.filter("is_duplicate")).first().reason == "no_unique_posts"


def test_status_gauge(spark):
    rows = [("p", 1, 1, "error"), ("p", 2, 2, "api_error"), ("q", 1, 3, "error"),
            ("q", 1, 4, "reset"), ("r", 1, 5, "success"), ("r", 2, 6, "api_error")]
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, kind string")
    got = agg.gauge_latest(agg.status_writes(df, "kind"), ["k"], "status", "t", "id").collect()
    assert {r.k: r.status for r in got} == {"p": 0.0, "q": 1.0, "r": 1.0}


def test_reconcile(spark):
    df = spark.range(50).select("id", (F.col("id") * 2).alias("t"))
    assert agg.snapshot_reconcile(df, df.orderBy(F.desc("id")), "t", ["id", "t"]).first().matches
    other = df.withColumn("id", F.when(F.col("id") == 7, 8).otherwise(F.col("id")))
    r = agg.snapshot_reconcile(df, other, "t", ["id", "t"]).first()
    assert r.original_rows == r.copy_rows and not r.same_content and not r.matches


def test_accuracy(spark):
    df = spark.createDataFrame([("a", "a", 3), ("a", "b", 1)], "l string, p string, n int")
    assert agg.accuracy(df, "l", "p").first()[0] == 0.75


def test_recordings_name_all_seven(spark):
    names = {r.record for r in ts.RECORDINGS}
    rows = []
    for metric in sorted({m for r in ts.RECORDINGS for m in (r.metric, r.other) if m}):
        rows += [(metric, "i", t, float(t)) for t in range(15, 3000, 15)]
    df = spark.createDataFrame(rows, "metric string, i string, t bigint, value double")
    got = ts.recording_rules(df, ts.RECORDINGS, ["i"], 1500, 2700, 300).collect()
    assert {r.record for r in got} == names and len(got) == 7 * 5
    by = {r.record: r.value for r in got if r.t == 2700}
    assert by["reddit:posts_processed_rate"] == 1.0 and by["reddit:duplication_rate"] == 1.0
    assert by["system:cpu_usage"] == 0.0 and by["system:disk_usage"] == 0.0


def test_rule_series_ages_and_values(spark):
    rows = [("backup_last_success_timestamp", "i", t, 100.0) for t in range(15, 3000, 15)]
    df = spark.createDataFrame(rows, "metric string, i string, t bigint, value double")
    rules = [("a", "backup_last_success_timestamp", "age", 0, ">", 500.0, 0, "x"),
             ("b", "backup_last_success_timestamp", "value", 0, ">", 500.0, 0, "x")]
    got = ts.rule_series(df, rules, ["i"], 600, 1200, 300).collect()
    assert {(r.func, r.t): r.value for r in got} == {
        ("age", 600): 500.0, ("age", 900): 800.0, ("age", 1200): 1100.0,
        ("value", 600): 100.0, ("value", 900): 100.0, ("value", 1200): 100.0}


# Bucket rates ---------------------------------------------------------------------------------

BOUNDS = [1.0, 5.0, 10.0, float("inf")]


def bucket_rows(seed, keys=("a", "b")):
    """Cumulative bucket counters that restart now and then; some scrapes lack a bound."""
    rnd = random.Random(seed)
    rows = []
    for k in keys:
        counts = [0.0] * len(BOUNDS)
        for t in sorted(rnd.sample(range(0, 6000, 10), 150)):
            if rnd.random() < 0.05:
                counts = [0.0] * len(BOUNDS)
            for _ in range(rnd.randrange(4)):
                v = rnd.uniform(0, 14)
                counts = [c + (v <= b) for c, b in zip(counts, BOUNDS)]
            rows += [(k, b, t, c) for b, c in zip(BOUNDS, counts) if b != 5.0 or rnd.random() > 0.2]
    return rows


def quantile_by_hand(rows, q, window, t, keys):
    growth = []
    for b in BOUNDS:
        grew = 0.0
        for k in keys:
            mine = sorted((x[2], x[3]) for x in rows if x[0] == k and x[1] == b)
            for (_, before), (at, now) in zip(mine, mine[1:]):
                if t - window < at <= t:
                    grew += now if now < before else now - before
        growth.append(max([grew, *growth]))
    if growth[-1] == 0:
        return None
    rank = q * growth[-1]
    i = next(i for i, c in enumerate(growth) if c >= rank)
    if BOUNDS[i] == float("inf"):
        return BOUNDS[i - 1]
    low, below = (BOUNDS[i - 1], growth[i - 1]) if i else (0.0, 0.0)
    return round(low + (BOUNDS[i] - low) * (rank - below) / (growth[i] - below), 6)


@pytest.mark.parametrize("q", [0.0001, 0.5, 0.95])
@pytest.mark.parametrize("by", [["k"], []])
def test_quantile_of_rates_by_hand(spark, q, by):
    rows = bucket_rows(int(q * 100) + len(by))
    df = spark.createDataFrame(rows, "k string, le double, t bigint, value double")
    df = df.withColumn("all", F.lit(1))
    got = {(r.k if by else None, r.t): r["quantile"] for r in ts.quantile_of_rates(
        df, q, ["k", "all"], BOUNDS, 600, 0, 6600, 300, by=by or ["all"]).collect()}
    want = {}
    for k in (["a", "b"] if by else [None]):
        for t in range(0, 6601, 300):
            if (v := quantile_by_hand(rows, q, 600, t, [k] if k else ["a", "b"])) is not None:
                want[k, t] = v
    assert got == pytest.approx(want, abs=2e-6) and len(want) > 10


def test_bucket_series_are_counters_of_their_own(spark):
    """A restart between two scrapes of one bound, and counts that fall from bound to bound."""
    rows = [("a", 1.0, 0, 9.0), ("a", 5.0, 0, 9.0), ("a", float("inf"), 0, 9.0),
            ("a", 1.0, 60, 2.0), ("a", float("inf"), 60, 3.0),  # 5.0 is missing
            ("a", 1.0, 120, 4.0), ("a", 5.0, 120, 1.0), ("a", float("inf"), 120, 5.0)]
    df = spark.createDataFrame(rows, "k string, le double, t bigint, value double")
    grown = ts.bucket_growth(ts.bucket_vectors(df, ["k"], [1.0, 5.0, float("inf")]), ["k"], 3)
    assert [(r.t, r.b0, r.b1, r.b2) for r in grown.sort("t").collect()] == [
        (0, 0.0, 0.0, 0.0), (60, 2.0, 0.0, 3.0), (120, 2.0, 1.0, 2.0)]
    half = ts.quantile_of_rates(df, 0.5, ["k"], [1.0, 5.0, float("inf")], 300, 0, 300, 300).collect()
    # Growth 4, 1, 5 is raised to 4, 4, 5; the rank 2.5 lies in the first bucket.
    assert [(r.t, r["quantile"]) for r in half] == [(300, 0.625)]
    with pytest.raises(ValueError):
        ts.quantile_of_rates(df, 0.5, ["k"], [1.0, 5.0], 300, 0, 300, 300)


# The series table -----------------------------------------------------------------------------

@pytest.mark.parametrize("start,step", [(0, 60), (700, 90)])
def test_series_table_by_brute_force(spark, start, step):
    """Windows that are no multiples of the step, silent stretches, restarts, stale values."""
    rnd = random.Random(start + step)
    rows = []
    for k in ("a", "b"):
        value = 0
        for t in sorted(rnd.sample([t for t in range(-1000, 4000) if not 1500 < t < 2600], 160)):
            value = rnd.randrange(5) if rnd.random() < 0.1 else value + rnd.randrange(4)
            rows.append((k, t, float(value)))
    df = spark.createDataFrame(rows, "k string, t bigint, value double")
    end, windows, look = start + 3000, [30, 240, 900], 100
    got = {(r.k, r.t): (r.value, r.sample_t, *[r[f"grown_{w}"] for w in windows])
           for r in ts.series_table(df, ["k"], windows, start, end, step, look).collect()}
    want = {}
    for k in ("a", "b"):
        mine = [(t, v) for kk, t, v in rows if kk == k]
        deltas = [(t, v if v < p else v - p) for (_, p), (t, v) in zip(mine, mine[1:])]
        for t in range(start, end + 1, step):
            seen = [(x, v) for x, v in mine if t - look < x <= t]
            last = seen[-1] if seen else (None, None)
            want[k, t] = (last[1], last[0], *[sum(d for x, d in deltas if t - w < x <= t) for w in windows])
    assert got == want


def test_one_scan_serves_all_rules(spark):
    rows = [("up", "a", 100, 1.0), ("c", "a", 100, 5.0), ("c", "a", 200, 25.0), ("used", "a", 100, 200.0), ("free", "a", 100, 50.0)]
    df = spark.createDataFrame(rows, "metric string, k string, t bigint, value double")
    rules = [("r1", "up", "value", 0, "==", 0.0, 0, "x"), ("r2", "c", "rate", 300, ">", 1.0, 0, "x"),
             ("r3", "c", "increase", 600, ">", 1.0, 0, "x"), ("r4", "percent_used", "value", 0, ">", 1.0, 0, "x")]
    series = ts.rule_series(df, rules, ["k"], 0, 900, 300, recordings=[ts.Recording("percent_used", "used", "used", "free")])
    got = {(r.metric, r.func, r.t): r.value for r in series.collect()}
    assert got["up", "value", 300] == 1.0 and ("up", "value", 600) not in got
    assert got["c", "rate", 300] == round(20 / 300, 9) and got["c", "rate", 600] == 0.0
    assert [got["c", "increase", t] for t in (0, 300, 600, 900)] == [0.0, 20.0, 20.0, 0.0]
    assert got["percent_used", "value", 300] == 75.0 and ("used", "value", 300) not in got
