"""Alert evaluation, notification flow and incident state.

Operators on raw events scan each alert in chunks of ``chunk_s`` seconds, or,
with ``block``, of single seconds cut by ranges of the event number; see
``ordered_scan``. The others first reduce to one row per alert and second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.incidents import alert_fingerprint
from tidemark.operators.ordered import EVENT_CHUNK_S, ordered_scan, row_place
from tidemark.operators.rules import (
    AUTO_ESCALATE_S,
    AUTO_RESOLVE_S,
    Route,
    by_severity,
    compare,
    route_column,
)
from tidemark.operators.timeseries import full_grid
from tidemark.session import staged

#: Chunk width for rows already reduced to one per alert and second or grid time.
POINT_CHUNK_S = 86400


def evaluate_rules(series: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule on each point of its metric: adds the rule columns and ``breach``.

    ``series`` holds one row per metric, function, window, labels and time; a
    rule meets the rows of its own metric, function and window only. Where the
    series have a ``labels`` map and the rules a selector, a rule reads the
    series that it selects; a label that is not there reads as ''.
    """
    joined = series.join(rules, ["metric", "func", "window_s"])
    if "labels" in series.columns and "label" in rules.columns:
        own = F.coalesce(F.try_element_at("labels", F.col("label")), F.lit(""))
        joined = joined.filter(
            F.col("label").isNull() | (own == F.col("label_is"))
            | F.rlike(own, F.concat(F.lit("^(?:"), F.col("label_like"), F.lit(")$"))))
    return joined.withColumn("breach", compare(F.col("value"), F.col("comparator"),
                                               F.col("threshold")))


def hold_for(points: DataFrame, keys: list[str], t: str = "t", breach: str = "breach",
             for_s: Column | None = None, step_s: int = 3600,
             chunk_s: int = POINT_CHUNK_S) -> DataFrame:
    """Adds ``since`` (start of the unbroken breach) and ``state``.

    ``state`` is ok, pending, or firing once the breach has held for ``for_s``.
    A point more than ``step_s`` after the one before starts anew.
    """
    for_s = for_s if for_s is not None else F.col("for_s")
    b = F.col(breach)
    near = ordered_scan(points, keys, t, prev={"__pb": b, "__pt": F.col(t)}, chunk_s=chunk_s)
    starts = b & (~F.coalesce(F.col("__pb"), F.lit(False)) | (F.col(t) - F.col("__pt") > step_s))
    held = ordered_scan(near, keys, t, fill={"since": F.when(starts, F.col(t))}, chunk_s=chunk_s)
    since = F.when(b, F.col("since"))
    return (held.drop("__pb", "__pt").withColumn("since", since)
            .withColumn("state", F.when(~b, "ok")
                        .when(F.col(t) - F.col("since") >= for_s, "firing").otherwise("pending")))


def alert_intervals(states: DataFrame, keys: list[str], t: str = "t",
                    value: str = "value") -> DataFrame:
    """Start, end and peak of every breach that came to fire.

    ``since`` identifies the interval, so this is a plain aggregation.
    """
    return (
        states.filter(F.col("since").isNotNull())
        .groupBy(*keys, F.col("since").alias("start_t"))
        .agg(F.max(t).alias("end_t"), F.max(value).alias("peak"),
             F.bool_or(F.col("state") == "firing").alias("__fired"))
        .filter("__fired").drop("__fired")
    )


def no_data(grid: DataFrame, samples: DataFrame, keys: list[str], t: str = "t",
            value: str = "value") -> DataFrame:
    """Grid points with their value and a ``data_state``: 'NoData' where none was there."""
    return grid.join(samples.select(*keys, t, value), [*keys, t], "left").withColumn(
        "data_state", F.when(F.col(value).isNull(), "NoData").otherwise("Normal"))


def rule_states(series: DataFrame, rules: DataFrame, keys: list[str], start: int, end: int,
                step_s: int, t: str = "t") -> DataFrame:
    """rule, keys, t, value, breach, state of every rule at every grid time.

    ``state`` is ok, pending or firing by the rule's own hold time. A rule that
    finds no series at a grid time, as its metric is absent, stale or selected
    by no label, has one row there, with null keys and the state NoData.
    """
    points = evaluate_rules(series, rules)
    held = hold_for(points.select("rule", *keys, t, "value", "breach", "for_s"), ["rule", *keys], t, step_s=step_s)
    held = held.select("rule", *keys, t, "value", "breach", "state")
    missing = full_grid(rules, ["rule"], start, end, step_s, t).join(points.select("rule", t), ["rule", t], "left_anti")
    nothing = {c: F.lit(None).cast(held.schema[c].dataType) for c in (*keys, "value")}
    silent = missing.withColumns(nothing | {"breach": F.lit(False), "state": F.lit("NoData")})
    return held.unionByName(silent)


def firing_changes(events: DataFrame, keys: list[str], t: str = "t", tie: str = "event_id",
                   status: str = "status", chunk_s: int = EVENT_CHUNK_S,
                   block: int | None = None) -> DataFrame:
    """Events that open or close an alert, with ``delta`` +1 / -1; the others are dropped."""
    known = events.filter(F.lower(status).isin("firing", "resolved")) \
        .withColumn("__now", F.lower(status) == "firing")
    seen = ordered_scan(known, keys, t, [tie], prev={"__was": F.col("__now")}, chunk_s=chunk_s,
                        block=block)
    was = F.coalesce(F.col("__was"), F.lit(False))
    return (seen.filter(F.col("__now") != was)
            .withColumn("delta", F.when(F.col("__now"), 1).otherwise(-1))
            .drop("__now", "__was"))


def inhibit(events: DataFrame, equal: list[str], alert_keys: list[str], t: str = "t",
            tie: str = "event_id", chunk_s: int = EVENT_CHUNK_S,
            block: int | None = None) -> DataFrame:
    """Firing events left after critical alerts silence the warnings they match.

    A warning is silenced at a time when some critical alert with the same
    ``equal`` labels is open; a missing label equals ''. Openings and closings
    of critical alerts and the times of warnings are summed to one row per
    label set and second, and a running count of open criticals decides: no
    warning is ever paired with a critical.
    """
    same = {f"__eq{i}": F.coalesce(F.col(k), F.lit("")) for i, k in enumerate(equal)}
    firing = events.filter(F.lower("status") == "firing")
    critical = firing_changes(events.filter(F.col("severity") == "critical"), alert_keys, t, tie,
                              chunk_s=chunk_s, block=block)
    marks = critical.withColumns(same).select(
        *same, t, F.col("delta").cast("bigint").alias("__delta"), F.lit(False).alias("__asks"))
    asks = firing.filter(F.col("severity") == "warning").withColumns(same).select(
        *same, t, F.lit(0).cast("bigint").alias("__delta"), F.lit(True).alias("__asks"))
    moments = marks.unionByName(asks).groupBy(*same, t).agg(
        F.sum("__delta").alias("__delta"), F.bool_or("__asks").alias("__asks"))
    line = ordered_scan(moments, list(same), t, running={"__open": F.col("__delta")})
    silenced = line.filter(F.col("__asks") & (F.col("__open") > 0)).select(
        *same, t, F.lit("warning").alias("severity"))
    return firing.withColumns(same).join(silenced, [*same, t, "severity"], "left_anti") \
        .select(*events.columns)


def route(alerts: DataFrame, routes: list[Route], default: str, out: str = "receiver") -> DataFrame:
    """One row per alert and receiver; the route table is compiled into the expression."""
    return alerts.withColumn(out, F.explode(route_column(routes, default)))


def group_alerts(alerts: DataFrame, by: list[str], t: str, interval_s: int) -> DataFrame:
    """Notification groups per interval: sizes, times and worst severity.

    Members stay rows of ``alerts``; a group's size has no bound, so it is
    described and never gathered into one array.
    """
    rank = by_severity({"critical": 3, "warning": 2, "info": 1}, 0)
    slot = (F.col(t) - F.pmod(F.col(t), F.lit(interval_s))).alias("slot")
    out = alerts.groupBy(*by, slot).agg(
        F.count(F.lit(1)).alias("alerts"), F.min(t).alias("first_t"), F.max(t).alias("last_t"),
        F.max(rank).alias("__rank"))
    worst = (F.when(F.col("__rank") == 3, "critical").when(F.col("__rank") == 2, "warning")
             .when(F.col("__rank") == 1, "info").otherwise("unknown"))
    return out.withColumn("worst_severity", worst).drop("__rank")


def group_windows(alerts: DataFrame, by: list[str], wait_s: Column, interval_s: int, idle_s: int,
                  t: str = "t", chunk_s: int = POINT_CHUNK_S) -> DataFrame:
    """Notifications of alert groups: by, severity, ``opened_t``, ``notify_t``, size and times.

    A group is opened by its first alert and notifies ``wait_s`` later, about
    all that came until then, and then every ``interval_s`` in which more came.
    It is over when nothing came for more than ``idle_s``; the next alert opens
    another. ``wait_s`` follows from ``by`` and the severity, which is part of
    the group, as it decides the route. Alerts of one second are one row of the
    scan, and a group is told by its opening time, so this is two chunked scans
    and an aggregation however long a group lives.
    """
    keys = [*by, "severity"]
    moments = alerts.groupBy(*keys, t).agg(F.count(F.lit(1)).alias("__n"), F.max(wait_s).cast("bigint").alias("__wait"))
    near = ordered_scan(moments, keys, t, prev={"__pt": F.col(t)}, chunk_s=chunk_s)
    opens = F.col("__pt").isNull() | (F.col(t) - F.col("__pt") > idle_s)
    lived = ordered_scan(near, keys, t, fill={"opened_t": F.when(opens, F.col(t))}, chunk_s=chunk_s)
    first = F.col("opened_t") + F.col("__wait")
    later = F.ceil((F.col(t) - first) / F.lit(interval_s)).cast("bigint") * interval_s
    due = first + F.greatest(later, F.lit(0).cast("bigint"))
    return lived.groupBy(*keys, "opened_t", due.alias("notify_t")).agg(
        F.sum("__n").alias("alerts"), F.min(t).alias("first_t"), F.max(t).alias("last_t"))


def throttle(alerts: DataFrame, keys: list[str], interval_s: Column, t: str = "t",
             chunk_s: int = POINT_CHUNK_S) -> DataFrame:
    """Times at which a notification goes out: at least the interval after the last one sent.

    Alerts of one second are one candidate; ``interval_s`` follows from the
    keys, and 0 sends every candidate. A candidate whose predecessor is a whole
    interval away is always sent. Every other one is sent if it is the successor
    of one that is, the first candidate an interval later; see :func:`chain`. All
    of it is joins and scans by (key, time), so that one busy key fills as many
    tasks as many.
    """
    moments = alerts.groupBy(*keys, t).agg(F.greatest(F.max(interval_s), F.lit(1)).cast("bigint").alias("__every"))
    near = ordered_scan(moments, keys, t, prev={"__pt": F.col(t)}, chunk_s=chunk_s)
    certain = F.col("__pt").isNull() | (F.col(t) - F.col("__pt") >= F.col("__every"))

    # Successors: every candidate asks at its time plus the interval, and the line is read backwards.
    mark = F.struct(F.col(t).alias("t"), certain.alias("certain"))
    line = near.select(*keys, t, "__every", "__pt", F.inline(F.array(
        F.struct((-F.col(t)).alias("__back"), F.lit(0).alias("__asks"), mark.alias("__mark")),
        F.struct((-F.col(t) - F.col("__every")).alias("__back"), F.lit(1).alias("__asks"), F.lit(None).cast("struct<t:bigint,certain:boolean>").alias("__mark")))))
    line = ordered_scan(line, keys, "__back", ["__asks"], fill={"__next": F.col("__mark")}, chunk_s=chunk_s)
    links = line.filter("__asks = 1").select(
        *keys, t, "__every", "__pt", certain.alias("__certain"), F.when(~F.col("__next.certain"), F.col("__next.t")).alias("__to"))
    return chain(links, keys, t).select(*keys, t)


def chain(links: DataFrame, keys: list[str], t: str) -> DataFrame:
    """The moments that chains of successors visit, from those that are ``__certain``.

    ``links`` has a row per moment: keys, ``__every``, ``__pt`` (the moment
    before) and ``__to`` (the successor, at least ``__every`` later; null where
    that is certain anyway). Pointers are doubled over chunks of time: a chunk of
    one interval holds one visited moment at most; a chunk of twice the width is
    left from where its half is left, or from where the other half is left after
    that. Only moments at which a chunk can be entered are kept, which follow its
    first interval at the latest, or are certain, so the tables shrink from round
    to round. When no chunk is left for another, the certain moments are all
    there is to start from; going back down, every chunk that is entered shows
    where its second half is. There are as many rounds as the logarithm of the
    longest chain; every second one is written, as each reads the one before
    twice.
    """
    def place(column: str, level: int) -> Column:
        return F.floor(F.col(column) / (F.col("__every") * (1 << level)))

    def joined(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
        """``left`` with ``__then``, the successor of its moment ``on`` in ``right``."""
        named = right.filter("__to IS NOT NULL").select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(t).alias("__at"), F.col("__to").alias("__then"))
        same = F.col(on) == F.col("__at")
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        return left.join(named, same, "left").drop("__at", *[f"__k{i}" for i in range(len(keys))])

    def doubled(lower: DataFrame, level: int) -> DataFrame:
        begin = place(t, level) * F.col("__every") * (1 << level)
        enters = F.col("__certain") | (F.col("__pt") < begin + F.col("__every"))
        pairs = joined(lower.filter(enters), lower, "__to")
        inside = place("__to", level) == place(t, level)
        return pairs.withColumn("__to", F.when(inside, F.col("__then")).otherwise(F.col("__to"))).drop("__then")

    def written(df: DataFrame) -> bool:
        """Adds a round; whether any of its chunks is left for another."""
        seen = Observation()
        rounds.append(staged(df.observe(seen, F.count("__to").alias("open")), "chain"))
        return bool(seen.get.get("open"))

    rounds: list[DataFrame] = []
    more = written(links)
    while more:
        rounds.append(doubled(rounds[-1], len(rounds)))
        more = written(doubled(rounds[-1], len(rounds)))

    columns = [*keys, "__every", t]
    sent = rounds[0].filter("__certain").select(*columns)
    for lower in reversed(range(len(rounds) - 1)):
        second = F.when(place("__then", lower + 1) == place(t, lower + 1), F.col("__then"))
        sent = joined(sent, rounds[lower], t).withColumn(t, F.explode(F.array_compact(F.array(F.col(t), second)))).select(*columns)
    return sent


def cap(notifications: DataFrame, keys: list[str], caps: list[tuple[int, int]], t: str = "t",
        tie: str = "event_id") -> DataFrame:
    """At most so many notifications per calendar bucket, narrow bucket first.

    Each bucket keeps its earliest; Spark limits every bucket before shuffling.
    """
    out = notifications
    for width, most in caps:
        slot = F.col(t) - F.pmod(F.col(t), F.lit(width))
        w = Window.partitionBy(*keys, "__slot").orderBy(t, tie)
        out = (out.withColumn("__slot", slot).withColumn("__r", F.row_number().over(w))
               .filter(F.col("__r") <= most).drop("__slot", "__r"))
    return out


def escalate(incidents: DataFrame, policy: DataFrame, as_of: int) -> DataFrame:
    """Steps whose delay passed while the incident was open.

    ``incidents`` has ``severity, start_t, end_t`` (null while open). The policy
    has a handful of rows; its exact size lets Spark pick the join.
    """
    until = F.least(F.coalesce(F.col("end_t"), F.lit(as_of)), F.lit(as_of))
    return (incidents.join(policy, "severity")
            .filter(F.col("start_t") + F.col("delay_s") <= until)
            .withColumn("due_t", F.col("start_t") + F.col("delay_s")))


def auto_escalate(incidents: DataFrame, as_of: int) -> DataFrame:
    """Adds ``auto_action``: escalate, resolve or none, by severity and age.

    Escalation counts from the start, resolution from the last activity
    (``last_t``); only open incidents are touched.
    """
    open_ = F.col("end_t").isNull()
    age = F.lit(as_of) - F.col("start_t")
    idle = F.lit(as_of) - F.col("last_t")
    return incidents.withColumn(
        "auto_action",
        F.when(open_ & (age >= by_severity(AUTO_ESCALATE_S)), "escalate")
        .when(open_ & (idle >= by_severity(AUTO_RESOLVE_S)), "resolve").otherwise("none"))


def with_alert_id(events: DataFrame) -> DataFrame:
    return events.withColumn("alert_id", alert_fingerprint(
        F.col("alertname"), F.col("service"), F.col("instance")))


def incident_actions(events: DataFrame, t: str = "t", tie: str = "event_id",
                     chunk_s: int = EVENT_CHUNK_S, block: int | None = None) -> DataFrame:
    """What each alert event does to its incident.

    Firing creates unless open, else updates; resolved closes if open, else
    nothing; any other status does nothing and does not count as a predecessor.
    """
    now = F.lower("status")
    state = F.when(now == "firing", True).when(now == "resolved", False)
    named = events.withColumn("__open", state)
    seen = ordered_scan(named, ["alert_id"], t, [tie], prior={"__was": F.col("__open")},
                        chunk_s=chunk_s, block=block)
    was = F.coalesce(F.col("__was"), F.lit(False))
    action = (F.when(F.col("__open").isNull(), "none")
              .when(F.col("__open"), F.when(was, "update").otherwise("create"))
              .otherwise(F.when(was, "close").otherwise("none")))
    return seen.withColumn("action", action).drop("__open", "__was")


def _last_status(events: DataFrame, keys: list[str], t: str, tie: str) -> DataFrame:
    """Per key the time of the last firing or resolved status and whether it was firing."""
    now = F.lower("status")
    return events.filter(now.isin("firing", "resolved")).groupBy(*keys).agg(
        F.max_by(now == "firing", row_place(events, t, [tie])).alias("__firing"),
        F.max(t).alias("last_t"))


def incident_state(events: DataFrame, t: str = "t", tie: str = "event_id") -> DataFrame:
    """Current state per alert: the last firing or resolved status seen."""
    state = F.when(F.col("__firing"), "open").otherwise("closed").alias("state")
    return _last_status(events, ["alert_id"], t, tie).select("alert_id", state, "last_t")


def incident_episodes(events: DataFrame, keys: list[str], carry: list[str] | None = None,
                      t: str = "t", tie: str = "event_id",
                      chunk_s: int = EVENT_CHUNK_S, block: int | None = None) -> DataFrame:
    """Open and close time of every incident; ``end_t`` is null while open."""
    changes = firing_changes(events, keys, t, tie, chunk_s=chunk_s, block=block)
    paired = ordered_scan(changes, keys, t, [tie], following={"end_t": F.col(t)}, chunk_s=chunk_s,
                          block=block)
    return paired.filter(F.col("delta") == 1).select(
        *keys, *(carry or []), F.col(tie).alias("incident_no"), F.col(t).alias("start_t"), "end_t")


def failure_streak(checks: DataFrame, keys: list[str], t: str = "t", tie: str = "event_id",
                   restart: int = 3, alert: int = 5, chunk_s: int = EVENT_CHUNK_S,
                   block: int | None = None) -> DataFrame:
    """Consecutive failures up to each check, and whether to restart or alert."""
    bad = ~F.col("healthy")
    counted = ordered_scan(checks, keys, t, [tie],
                           running={"__bad": bad.cast("bigint")}, chunk_s=chunk_s,
                           block=block)
    reset = ordered_scan(counted, keys, t, [tie],
                         fill={"__base": F.when(~bad, F.col("__bad"))}, chunk_s=chunk_s,
                         block=block)
    streak = F.col("__bad") - F.coalesce(F.col("__base"), F.lit(0))
    return (reset.withColumn("streak", streak).drop("__bad", "__base")
            .withColumn("needs_restart", F.col("streak") >= restart)
            .withColumn("needs_alert", F.col("streak") >= alert))


def resource_issues(readings: DataFrame, max_memory_mb: float = 2048.0,
                    max_cpu_percent: float = 80.0, max_disk_percent: float = 85.0) -> DataFrame:
    """Joined messages of the readings over their limits; healthy when there are none."""
    issues = F.concat_ws(
        "; ",
        F.when(F.col("memory_mb") > max_memory_mb,
               F.format_string("High memory usage: %.0fMB", "memory_mb")),
        F.when(F.col("cpu_percent") > max_cpu_percent,
               F.format_string("High CPU usage: %.1f%%", "cpu_percent")),
        F.when(F.col("disk_percent") > max_disk_percent,
               F.format_string("High disk usage: %.1f%%", "disk_percent")))
    return readings.withColumn("issues", issues).withColumn("healthy", F.col("issues") == "")


def active_alerts(events: DataFrame, keys: list[str], t: str = "t",
                  tie: str = "event_id") -> DataFrame:
    """Alerts whose last known status is firing."""
    return _last_status(events, keys, t, tie).filter("__firing").drop("__firing")
