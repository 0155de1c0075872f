import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.incidents import alert_fingerprint, incident_labels, incident_title
from tidemark.operators import alerting as al
from tidemark.operators import manifests as mf
from tidemark.operators import rules as ru
from tidemark.session import values_frame
from tidemark.sources.telemetry import explode_payloads


def test_rule_tables_fit_their_schema(spark):
    for table in (ru.METRIC_RULES, ru.APPLICATION_RULES, ru.JOB_RULES):
        assert values_frame(spark, ru.RULE_SCHEMA, table).count() == len(table)
    policy = values_frame(spark, ru.ESCALATION_SCHEMA, ru.ESCALATION)
    assert policy.filter("severity = 'critical'").count() == 3


def test_rules_meet_their_metric_only(spark):
    series = spark.createDataFrame(
        [("up", "value", 0, 10, 0.0), ("up", "value", 0, 20, 1.0),
         ("posts_processed_total", "increase", 14400, 10, 0.0),
         ("posts_processed_total", "rate", 300, 10, 0.0), ("up", "value", 0, 30, None)],
        "metric string, func string, window_s bigint, t bigint, value double")
    got = al.evaluate_rules(series, values_frame(spark, ru.RULE_SCHEMA, ru.METRIC_RULES))
    assert {(r.rule, r.t, r.breach) for r in got.collect()} == {
        ("PipelineDown", 10, True), ("PipelineDown", 20, False), ("PipelineDown", 30, False),
        ("NoDataProcessed", 10, True)}


def _hold(points, for_s, step_s):
    since, seen, out = None, None, []
    for t, b in points:
        if not b:
            since, state = None, "ok"
        else:
            if since is None or t - seen > step_s:
                since = t
            state = "firing" if t - since >= for_s else "pending"
        seen = t
        out.append((t, since, state))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_hold_and_intervals(spark, seed):
    rnd = random.Random(seed)
    points = [(t, rnd.random() < 0.8) for t in sorted(rnd.sample(range(0, 6000, 15), 200))]
    df = spark.createDataFrame([("k", t, b, float(t % 7)) for t, b in points],
                               "k string, t bigint, breach boolean, value double")
    states = al.hold_for(df, ["k"], for_s=F.lit(60), step_s=30, chunk_s=100)
    want = _hold(points, 60, 30)
    assert [(r.t, r.since, r.state) for r in states.sort("t").collect()] == want
    fired = {s for _, s, state in want if state == "firing"}
    spans = al.alert_intervals(states, ["k"]).collect()
    assert {r.start_t for r in spans} == fired
    for r in spans:
        inside = [t for t, s, _ in want if s == r.start_t]
        assert r.end_t == max(inside) and r.peak == max(t % 7 for t in inside)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_throttle_is_greedy(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["hot", "hot", "hot", "a"]), rnd.randrange(4000)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, t bigint")
    got = {(r.k, r.t) for r in al.throttle(df, ["k"], F.lit(25 * seed), chunk_s=300).collect()}
    want = set()
    for k in ("hot", "a"):
        last = None
        for t in sorted({t for kk, t in rows if kk == k}):
            if last is None or t - last >= 25 * seed:
                want.add((k, t))
                last = t
    assert got == want


def greedy(rows, every):
    want = set()
    for k in {k for k, _ in rows}:
        last = None
        for t in sorted({t for kk, t in rows if kk == k}):
            if last is None or t - last >= every[k]:
                want.add((k, t))
                last = t
    return want


def test_throttle_of_long_stretches(spark):
    """Dense, sparse and clustered lines, null keys, and an interval for each key."""
    rnd = random.Random(8)
    every = {"dense": 7, "hot": 60, "sparse": 50, None: 30, "free": 0, "pairs": 10}
    rows = [("dense", t) for t in range(2000)] + [("hot", rnd.randrange(40_000)) for _ in range(9000)]
    rows += [("sparse", 100 * t) for t in range(50)] + [(None, rnd.randrange(900)) for _ in range(400)]
    rows += [("free", t) for t in range(0, 300, 2)] + [("pairs", 10 * t + d) for t in range(0, 300, 3) for d in (0, 9)]
    df = spark.createDataFrame(rows, "k string, t bigint")
    col = F.lit(30)
    for k, e in every.items():
        col = F.when(F.col("k") == k, e).otherwise(col) if k else col
    got = [(r.k, r.t) for r in al.throttle(df, ["k"], col, chunk_s=500).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy(rows, every)


def test_a_busy_key_fills_many_tasks(spark):
    """One key with an alert every second: no table of the rounds has a task with much more than its part."""
    df = spark.range(40_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    sent = al.throttle(df, ["k"], F.lit(600), chunk_s=2000)
    assert sorted(r.t for r in sent.collect()) == list(range(0, 40_000, 600))
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    # Joins are by key and time, never by key alone.
    assert not any("hashpartitioning(k" in line and ", t" not in line and "__then" not in line and "__at" not in line
                   for line in plan.splitlines())


def test_rules_with_and_without_data(spark):
    rules = [("Down", "up", "value", 0, "==", 0.0, 120, "critical", "job", "mine", None),
             ("Any", "up", "value", 0, "==", 0.0, 0, "critical", None, None, None),
             ("Gone", "nowhere", "value", 0, ">", 0.0, 0, "info", None, None, None)]
    up = [("a", "mine", 0, 0.0), ("a", "mine", 60, 0.0), ("a", "mine", 120, 0.0), ("a", "mine", 240, 0.0), ("b", "other", 180, 1.0)]
    series = spark.createDataFrame([("up", "value", 0, k, job, t, v) for k, job, t, v in up],
                                   "metric string, func string, window_s bigint, k string, job string, t bigint, value double")
    series = series.withColumn("labels", F.create_map(F.lit("job"), "job"))
    got = al.rule_states(series, values_frame(spark, ru.RULE_SCHEMA, rules), ["k"], 0, 240, 60)
    by = {(r.rule, r.k, r.t): r.state for r in got.collect()}
    assert [by.get(("Down", "a", t)) for t in range(0, 241, 60)] == ["pending", "pending", "firing", None, "pending"]
    assert by["Down", None, 180] == "NoData" and ("Any", None, 180) not in by and by["Any", "b", 180] == "ok"
    assert [by["Gone", None, t] for t in range(0, 241, 60)] == ["NoData"] * 5


@pytest.mark.parametrize("seed", [1, 2])
def test_group_windows_by_hand(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "a", "b", None]), rnd.choice(["critical", "info"]), rnd.randrange(30_000)) for _ in range(600)]
    rows += [("a", "critical", t) for t in range(40_000, 44_000, 7)]
    df = spark.createDataFrame(rows, "k string, severity string, t bigint")
    wait = {"critical": 30, "info": 10}
    got = {tuple(r) for r in al.group_windows(df, ["k"], ru.by_severity(wait), 100, 250, chunk_s=900).select(
        "k", "severity", "opened_t", "notify_t", "alerts", "first_t", "last_t").collect()}
    want = {}
    for k, severity in {r[:2] for r in rows}:
        opened = last = due = None
        for t in sorted(r[2] for r in rows if r[:2] == (k, severity)):
            if last is None or t - last > 250:
                opened, due = t, t + wait[severity]
            while t > due:
                due += 100
            want.setdefault((k, severity, opened, due), []).append(t)
            last = t
    assert got == {(*key, len(ts), min(ts), max(ts)) for key, ts in want.items()}


def test_caps_keep_the_earliest(spark):
    df = spark.range(100).select(F.lit("k").alias("k"), F.col("id").alias("event_id"),
                                 (F.col("id") * 60).alias("t"))
    got = sorted(r.event_id for r in al.cap(df, ["k"], [(3600, 10), (86400, 15)]).collect())
    assert got == list(range(10)) + list(range(60, 65))


def test_routes(spark):
    rows = [(1, "critical", "svc"), (2, "warning", "svc"), (3, "info", "svc"), (4, "info", "x"),
            (5, None, None)]
    df = spark.createDataFrame(rows, "id int, severity string, service string")
    got = {r.id: r.receiver for r in al.route(df, ru.receiver_routes("svc"), ru.DEFAULT_RECEIVER)
           .collect()}
    assert got == {1: "github-critical", 2: "github-warning", 3: "github-pipeline",
                   4: "default-receiver", 5: "default-receiver"}
    both = [ru.Route({"severity": "info"}, ["a"], proceed=True), ru.Route({"service": "x"}, ["b"])]
    got = al.route(df, both, "d").filter("id in (3, 4)").collect()
    assert sorted((r.id, r.receiver) for r in got) == [(3, "a"), (4, "a"), (4, "b")]


def test_inhibit(spark):
    schema = ("event_id bigint, t bigint, alertname string, severity string, service string, "
              "instance string, status string")
    rows = [(1, 10, "A", "critical", "s", "i", "firing"), (2, 20, "B", "warning", "s", "i", "firing"),
            (3, 30, "A", "critical", "s", "i", "resolved"), (4, 30, "B", "warning", "s", "i", "firing"),
            (5, 20, "B", "warning", "other", "i", "firing"), (6, 10, "C", "warning", "s", "i", "firing"),
            (7, 25, "D", "info", "s", "i", "firing")]
    df = spark.createDataFrame(rows, schema)
    keys = ["alertname", "service", "instance"]
    left = {r.event_id for r in al.inhibit(df, ["service"], keys).collect()}
    assert left == {1, 4, 5, 7}
    left = {r.event_id for r in al.inhibit(df, ru.INHIBIT_BY_ALERT, keys).collect()}
    assert left == {1, 2, 4, 5, 6, 7}


def test_incidents(spark):
    rows = [(1, 1, "a", "resolved"), (2, 2, "a", "FIRING"), (3, 3, "a", "unknown"),
            (4, 4, "a", "firing"), (5, 5, "a", "resolved"), (6, 6, "a", "resolved"),
            (7, 7, "b", "firing")]
    df = spark.createDataFrame(rows, "event_id bigint, t bigint, alert_id string, status string")
    got = {r.event_id: r.action for r in al.incident_actions(df).collect()}
    assert got == {1: "none", 2: "create", 3: "none", 4: "update", 5: "close", 6: "none",
                   7: "create"}
    assert {r.alert_id: r.state for r in al.incident_state(df).collect()} == {
        "a": "closed", "b": "open"}
    spans = al.incident_episodes(df, ["alert_id"]).collect()
    assert {(r.alert_id, r.start_t, r.end_t) for r in spans} == {("a", 2, 5), ("b", 7, None)}


def test_escalation(spark):
    df = spark.createDataFrame([("critical", 0, 400), ("critical", 0, None), ("warning", 0, 100),
                                ("info", 0, None)], "severity string, start_t bigint, end_t bigint")
    policy = values_frame(spark, ru.ESCALATION_SCHEMA, ru.ESCALATION)
    got = sorted((r.severity, r.end_t or -1, r.step) for r in al.escalate(df, policy, 1000).collect())
    assert got == [("critical", -1, 1), ("critical", -1, 2), ("critical", -1, 3),
                   ("critical", 400, 1), ("critical", 400, 2), ("info", -1, 1), ("warning", 100, 1)]
    auto = al.auto_escalate(df.withColumn("last_t", F.lit(0)), 90000).collect()
    assert [r.auto_action for r in auto] == ["none", "escalate", "none", "resolve"]


def test_streak(spark):
    ok = [True, False, False, False, False, False, True, False]
    df = spark.createDataFrame([("c", i * 100, i, h) for i, h in enumerate(ok)],
                               "k string, t bigint, event_id bigint, healthy boolean")
    got = [(r.streak, r.needs_restart, r.needs_alert)
           for r in al.failure_streak(df, ["k"], chunk_s=150).sort("t").collect()]
    assert [g[0] for g in got] == [0, 1, 2, 3, 4, 5, 0, 1]
    assert [g[1] for g in got] == [False] * 3 + [True] * 3 + [False] * 2
    assert [g[2] for g in got] == [False] * 5 + [True] + [False] * 2


def test_incident_columns(spark):
    df = spark.createDataFrame([("Critical", "A", "s", "db", "i"), (None, None, None, None, None)],
                               "sev string, n string, s string, c string, i string")
    r = df.select(incident_title(F.col("sev"), F.col("n"), F.col("s")).alias("t"),
                  incident_labels(F.col("sev"), F.col("s"), F.col("c")).alias("l"),
                  alert_fingerprint(F.col("n"), F.col("s"), F.col("i")).alias("f")).collect()
    assert r[0].t == "CRITICAL: A - s" and r[1].t == "UNKNOWN: Unknown Alert - unknown-service"
    assert r[0].l == ["alert", "monitoring", "automated", "severity-critical", "service-s",
                      "component-db"] and r[1].l == ["alert", "monitoring", "automated"]
    import hashlib

    assert r[0].f == hashlib.md5(b"A-s-i").hexdigest()[:8]
    assert r[1].f == hashlib.md5(b"--").hexdigest()[:8]


def test_payload(spark):
    body = ('{"receiver": "w", "status": "firing", "alerts": [{"status": "firing", "labels": '
            '{"alertname": "ServiceDown", "instance": "c:8080", "severity": "critical"}, '
            '"annotations": {"description": "down"}, "startsAt": "2024-01-01T00:00:00Z"}, {}]}')
    df = spark.createDataFrame([(1, body), (2, '{"alerts": []}'), (3, "broken")],
                               "id int, body string")
    got = explode_payloads(df).collect()
    assert [(r.id, r.alertname, r.severity, r.service, r.instance, r.component, r.description,
             r.status) for r in got] == [
        (1, "ServiceDown", "critical", "unknown", "c:8080", "", "down", "firing"),
        (1, "Unknown", "unknown", "unknown", "unknown", "", "", "unknown")]


def test_resources(spark):
    df = spark.createDataFrame([(3000.4, 80.0, 85.04), (1.0, 95.55, 99.0), (1.0, 1.0, 1.0)],
                               "memory_mb double, cpu_percent double, disk_percent double")
    got = [(r.issues, r.healthy) for r in al.resource_issues(df).collect()]
    assert got[0] == ("High memory usage: 3000MB; High disk usage: 85.0%", False)
    assert got[1][0].startswith("High CPU usage: 95.") and got[2] == ("", True)


def test_retention_and_names(spark):
    day = 86400
    rows = [("a", "daily", 7), ("b", "daily", 8), ("c", "weekly", 28), ("d", "weekly", 29),
            ("e", "monthly", 361), ("f", "manual", 5000)]
    df = spark.createDataFrame([(n, k, 10_000 * day - d * day) for n, k, d in rows],
                               "name string, type string, created_t bigint")
    got = [r.name for r in mf.retention_select(df, 10_000 * day).collect()]
    assert got == ["b", "d", "e"]
    names = spark.createDataFrame([("daily_20240101_000007.tar.gz",), ("odd",)], "name string")
    got = names.select(*mf.parse_snapshot_name()).collect()
    assert tuple(got[0]) == ("daily", 1704067207) and tuple(got[1]) == (None, None)


def test_manifest_diff_and_verify(spark):
    old = spark.createDataFrame([("a", 2000, "1"), ("b", 2000, "1"), ("c", 10, "1")],
                                "path string, size bigint, checksum string")
    new = spark.createDataFrame([("a", 2000, "1"), ("b", 2000, "2"), ("d", 10, "1"), ("c", 10, None)],
                                "path string, size bigint, checksum string")
    got = {r.path: r.change for r in mf.manifest_diff(old, new).collect()}
    assert got == {"a": "same", "b": "changed", "c": "changed", "d": "added"}
    seen = mf.manifest_verify(old, new)
    assert {r.path: r.passed for r in seen.collect()} == {"a": True, "b": True, "c": False}
    assert mf.verification_summary(seen).first().status == "failed"


def test_rules_read_only_the_series_they_select(spark):
    from tidemark.operators import rules as r
    from tidemark.session import values_frame

    chosen = r.for_service([x for x in [*r.METRIC_RULES, *r.DASHBOARD_RULES] if x[1] == "up"], "svc")
    chosen += [("Any", "up", "value", 0, "==", 0.0, 0, "info", None, None, None),
               ("Like", "up", "value", 0, "==", 0.0, 0, "info", "job", None, "sv.")]
    series = spark.sql("""SELECT 'up' AS metric, 'value' AS func, 0L AS window_s, 5L AS t, 0D AS value, labels
        FROM VALUES (map('job', 'svc')), (map('job', 'svcx')), (map()) AS v(labels)""")
    out = al.evaluate_rules(series, values_frame(spark, r.RULE_SCHEMA, chosen)).collect()
    got = sorted((x.rule, x.labels.get("job", "")) for x in out if x.breach)
    assert got == [("Any", ""), ("Any", "svc"), ("Any", "svcx"), ("Like", "svc"), ("PipelineDown", "svc"),
                   ("Service Down Alert", "svc")]
