"""Range, as-of and quantile operators on metric samples.

Samples are rows ``(keys..., t BIGINT seconds, value DOUBLE)``, one per series
and time; label maps become key columns with ``label_columns``. Windows are
left-open, ``(t - w, t]``, without extrapolation at their ends.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.ordered import CHUNK_S, ordered_scan, range_sum, range_sums
from tidemark.session import staged

#: Evaluation step and look-back in seconds (fixed values).
STEP_S = 15
LOOKBACK_S = 300


def collapse(samples: DataFrame, keys: list[str], t: str = "t", value: str = "value",
             tie: str | None = None) -> DataFrame:
    """One sample per series and time: the last by ``tie``, or the largest value."""
    pick = F.max_by(value, tie) if tie else F.max(value)
    return samples.groupBy(*keys, t).agg(pick.alias(value))


def counter_deltas(samples: DataFrame, keys: list[str], t: str = "t", value: str = "value",
                   chunk_s: int = CHUNK_S) -> DataFrame:
    """Growth since the sample before; after a restart the new value is the growth.

    The first sample of a series grows by nothing.
    """
    v = F.col(value)
    seen = ordered_scan(samples, keys, t, prev={"__before": v}, chunk_s=chunk_s)
    delta = (F.when(F.col("__before").isNull(), 0.0).when(v < F.col("__before"), v)
             .otherwise(v - F.col("__before")))
    return seen.withColumn("delta", delta).drop("__before")


def counter_increase(samples: DataFrame, keys: list[str], window_s: int, t: str = "t",
                     value: str = "value", name: str = "increase",
                     chunk_s: int = CHUNK_S) -> DataFrame:
    """Reset-aware growth over the window that ends at each sample."""
    deltas = counter_deltas(samples, keys, t, value, chunk_s)
    return range_sum(deltas, keys, t, "delta", window_s, name).drop("delta")


def counter_rate(samples: DataFrame, keys: list[str], window_s: int, t: str = "t",
                 value: str = "value", name: str = "rate") -> DataFrame:
    """Growth per second over the window that ends at each sample."""
    grown = counter_increase(samples, keys, window_s, t, value, "__increase")
    return grown.withColumn(name, F.round(F.col("__increase") / float(window_s), 9)) \
        .drop("__increase")


def duration_rate(samples: DataFrame, keys: list[str], window_s: int, t: str = "t",
                  total: str = "sum", count: str = "count") -> DataFrame:
    """Growth per second of a histogram's sum, and the mean of what was observed in the window.

    ``samples`` have the ``_sum`` and ``_count`` counters of a scrape side by
    side; both restart together. Null mean where nothing was observed.
    """
    seen = ordered_scan(samples, keys, t, prev={"__s": F.col(total), "__c": F.col(count)})

    def grown(now: str, before: str) -> Column:
        return (F.when(F.col(before).isNull(), 0.0).when(F.col(now) < F.col(before), F.col(now))
                .otherwise(F.col(now) - F.col(before)))

    deltas = seen.select(*keys, t, grown(total, "__s").alias("__ds"), grown(count, "__c").alias("__dc"))
    sums = range_sums(deltas, keys, t, {"__sum": "__ds", "__count": "__dc"}, window_s)
    return sums.select(*keys, t, F.round(F.col("__sum") / float(window_s), 6).alias("seconds_per_second"),
                       F.when(F.col("__count") > 0, F.round(F.col("__sum") / F.col("__count"), 6)).alias("mean"))


def per_hour(rate: Column) -> Column:
    return F.round(rate * 3600.0, 6)


def grid_cell(t: Column, step_s: int) -> Column:
    """The first grid time at or after ``t``; the grid is aligned to the epoch."""
    return t + F.pmod(-t, F.lit(step_s))


def full_grid(series: DataFrame, keys: list[str], start: int, end: int, step_s: int,
              t: str = "t") -> DataFrame:
    """Every grid time for every series, silent ones included.

    Each series is cut into stretches that are spread before they are filled
    in, so that a few series over a long time still make many tasks.
    """
    stretch = step_s * max(1, 86400 // step_s)

    def steps(first: Column, last: Column, by: int) -> Column:
        return F.explode(F.sequence(first, last, F.lit(by).cast("bigint")))

    begin, stop = F.lit(start).cast("bigint"), F.lit(end).cast("bigint")
    spread = series.select(*keys).distinct() \
        .withColumn("__from", steps(begin, stop, stretch)).repartition(*keys, "__from")
    until = F.least(F.col("__from") + (stretch - step_s), stop)
    return spread.withColumn(t, steps(F.col("__from"), until, step_s)).drop("__from")


def increase_on_grid(samples: DataFrame, keys: list[str], window_s: int, start: int, end: int,
                     step_s: int = STEP_S, t: str = "t", value: str = "value",
                     name: str = "increase") -> DataFrame:
    """:func:`counter_increase` at every grid time, zero where a series was silent.

    ``window_s`` is a multiple of ``step_s``. Growth is first summed per grid
    cell, so the range window sees at most one row per series and grid time.
    """
    if window_s % step_s:
        raise ValueError("the window must be a multiple of the step")
    cells = (
        counter_deltas(samples, keys, t, value)
        .withColumn(t, grid_cell(F.col(t) - start, step_s) + start)
        .filter((F.col(t) > start - window_s) & (F.col(t) <= end))
        .select(*keys, t, "delta")
    )
    grid = full_grid(samples, keys, start, end, step_s, t).withColumn("delta", F.lit(0.0))
    dense = cells.unionByName(grid).groupBy(*keys, t).agg(F.sum("delta").alias("delta"))
    return (range_sum(dense, keys, t, "delta", window_s, name).drop("delta")
            .filter((F.col(t) >= start) & (F.col(t) <= end)))


def rate_on_grid(samples: DataFrame, keys: list[str], window_s: int, start: int, end: int,
                 step_s: int = STEP_S, t: str = "t", value: str = "value",
                 name: str = "rate") -> DataFrame:
    grown = increase_on_grid(samples, keys, window_s, start, end, step_s, t, value, "__inc")
    return grown.withColumn(name, F.round(F.col("__inc") / float(window_s), 9)).drop("__inc")


def ratio(num: DataFrame, den: DataFrame, on: list[str], value: str, name: str = "ratio",
          scale: float = 1.0) -> DataFrame:
    """``num / den`` on identical keys and time; null where nothing was counted.

    Both sides are first summed to the shared keys: series whose label sets
    differ have no common identity otherwise.
    """
    n = num.groupBy(*on).agg(F.sum(value).alias("__n"))
    d = den.groupBy(*on).agg(F.sum(value).alias("__d"))
    return n.join(d, on).select(*on, F.round(F.try_divide("__n", "__d") * scale, 6).alias(name))


def ratio_of(df: DataFrame, numerator: Column, denominator: Column, on: list[str], value: str,
             name: str = "ratio", scale: float = 1.0) -> DataFrame:
    """:func:`ratio` for two sides that live in one frame: one aggregation, no join."""
    out = df.filter(numerator | denominator).groupBy(*on).agg(
        F.sum(F.when(numerator, F.col(value))).alias("__n"),
        F.sum(F.when(denominator, F.col(value))).alias("__d"))
    return out.filter(F.col("__n").isNotNull() & F.col("__d").isNotNull()).select(
        *on, F.round(F.try_divide("__n", "__d") * scale, 6).alias(name))


def histogram_quantile(buckets: DataFrame, q: float, by: list[str], le: str = "le",
                       count: str = "cumulative", name: str = "quantile") -> DataFrame:
    """Quantile by linear interpolation inside the first bucket that reaches ``q``.

    In the ``+Inf`` bucket the highest finite bound is returned; a lowest bucket
    with a positive bound starts at 0. A group has one row per bound, so its
    rows are few however many observations were counted.
    """
    w = Window.partitionBy(*by).orderBy(le)
    whole = Window.partitionBy(*by)
    inf = float("inf")
    ranked = buckets.select(
        *by, F.col(le).alias("__le"), F.col(count).cast("double").alias("__c"),
        F.lag(le).over(w).alias("__low"), F.lag(F.col(count).cast("double")).over(w).alias("__below"),
        F.max(F.col(count).cast("double")).over(whole).alias("__total"))
    low = F.coalesce(F.col("__low"), F.least(F.lit(0.0), F.col("__le")))
    below = F.coalesce(F.col("__below"), F.lit(0.0))
    rank = F.col("__total") * q
    inside = low + (F.col("__le") - low) * F.try_divide(rank - below, F.col("__c") - below)
    value = (F.when(F.col("__le") == inf, F.col("__low"))
             .when(F.col("__low").isNull() & (F.col("__le") <= 0), F.col("__le"))
             .otherwise(inside))
    hit = ranked.filter((F.col("__c") >= rank) & (F.col("__total") > 0))
    return hit.groupBy(*by).agg(F.round(F.min_by(value, "__le"), 6).alias(name))


def bucket_vectors(samples: DataFrame, keys: list[str], bounds: list[float], t: str = "t",
                   le: str = "le", value: str = "value") -> DataFrame:
    """Bucket series of one scrape side by side: a row per ``keys`` and ``t``, columns ``b0``, ``b1``...

    ``samples`` have a row per bound; bounds that are not among ``bounds`` are
    left out, and one that a scrape lacks is null.
    """
    held = samples.filter(F.col(le).isin([float(b) for b in bounds]))
    return held.groupBy(*keys, t).agg(*[
        F.max(F.when(F.col(le) == float(b), F.col(value))).alias(f"b{i}") for i, b in enumerate(bounds)])


def bucket_growth(vectors: DataFrame, keys: list[str], size: int, t: str = "t",
                  chunk_s: int = CHUNK_S) -> DataFrame:
    """Growth of each of the ``size`` bucket counters since its last sample, columns ``b0``, ``b1``...

    Every bucket is a counter of its own: its last sample is the last one in
    which it was there, and a smaller value is a restart.
    """
    names = [f"b{i}" for i in range(size)]
    seen = ordered_scan(vectors, keys, t, prior={f"__{n}": F.col(n) for n in names}, chunk_s=chunk_s)

    def grown(n: str) -> Column:
        now, before = F.col(n), F.col(f"__{n}")
        return (F.when(now.isNull() | before.isNull(), 0.0).when(now < before, now)
                .otherwise(now - before)).alias(n)

    return seen.select(*keys, t, *[grown(n) for n in names])


def quantile_of_counts(q: float, bounds: list[float], counts: list[Column]) -> Column:
    """Quantile of cumulative ``counts`` at ascending ``bounds``, the last of which is infinity.

    Counts that fall from one bound to the next, as scrapes between two buckets
    leave them, are first raised to the largest before. Null without counts.
    """
    so_far = [counts[0]] + [F.greatest(*counts[:i + 1]) for i in range(1, len(counts))]
    total = so_far[-1]
    rank = total * q
    result = F.lit(None).cast("double")
    for i in reversed(range(len(bounds))):
        if bounds[i] == float("inf"):
            here = F.lit(float(bounds[i - 1])) if i else F.lit(None).cast("double")
        elif i == 0 and bounds[0] <= 0:
            here = F.lit(float(bounds[0]))
        else:
            low, below = (float(bounds[i - 1]), so_far[i - 1]) if i else (0.0, F.lit(0.0))
            here = F.lit(low) + F.lit(float(bounds[i]) - low) * F.try_divide(rank - below, so_far[i] - below)
        result = F.when(so_far[i] >= rank, here).otherwise(result)
    return F.when(total > 0, result)


def quantile_of_rates(samples: DataFrame, q: float, keys: list[str], bounds: list[float],
                      window_s: int, start: int, end: int, step_s: int = STEP_S,
                      by: list[str] | None = None, t: str = "t", le: str = "le",
                      value: str = "value", name: str = "quantile") -> DataFrame:
    """``histogram_quantile(q, sum by (by, le) (rate(bucket[window])))`` on the grid.

    ``samples`` are cumulative bucket counters, a row per bound. The buckets of
    a scrape travel as one row, so ordered scan, grid cells and range window
    see a row per scrape, however many bounds there are. ``by`` are the keys
    that are left, all of them if not given. Growth is left undivided, as the
    window cancels out. Grid times at which nothing was counted give no row.
    """
    if window_s % step_s:
        raise ValueError("the window must be a multiple of the step")
    bounds = sorted(float(b) for b in bounds)
    if not bounds or bounds[-1] != float("inf"):
        raise ValueError("the last bound must be infinity")
    by = keys if by is None else by
    names = [f"b{i}" for i in range(len(bounds))]
    vectors = bucket_vectors(samples, keys, bounds, t, le, value)
    cells = (
        bucket_growth(vectors, keys, len(bounds), t)
        .withColumn(t, grid_cell(F.col(t) - start, step_s) + start)
        .filter((F.col(t) > start - window_s) & (F.col(t) <= end))
    )
    grid = full_grid(samples, by, start, end, step_s, t).withColumns({n: F.lit(0.0) for n in names})
    dense = cells.select(*by, t, *names).unionByName(grid).groupBy(*by, t).agg(
        *[F.sum(n).alias(n) for n in names])
    summed = range_sums(dense, by, t, {f"w{n}": n for n in names}, window_s)
    quantile = quantile_of_counts(q, bounds, [F.col(f"w{n}") for n in names])
    return (summed.filter((F.col(t) >= start) & (F.col(t) <= end))
            .select(*by, t, F.round(quantile, 6).alias(name)).filter(F.col(name).isNotNull()))


def used_percent(df: DataFrame, on: list[str], metric: str, total: str, free: str, value: str,
                 name: str = "used_percent") -> DataFrame:
    """``(total - free) / total * 100`` of two gauges, by one conditional aggregation."""
    out = df.filter(F.col(metric).isin(total, free)).groupBy(*on).agg(
        F.max(F.when(F.col(metric) == total, F.col(value))).alias("__t"),
        F.max(F.when(F.col(metric) == free, F.col(value))).alias("__f"))
    return out.filter(F.col("__t").isNotNull() & F.col("__f").isNotNull()).select(
        *on, F.round(F.try_divide(F.col("__t") - F.col("__f"), F.col("__t")) * 100.0, 6)
        .alias(name))


def busy_percent(idle_rates: DataFrame, by: list[str], rate: str = "rate",
                 name: str = "busy_percent") -> DataFrame:
    """``100 - avg(rate of the idle counter) * 100`` across series."""
    mean = F.sum(F.col(rate).cast("decimal(28,9)")).cast("double") / F.count(rate).cast("double")
    return idle_rates.groupBy(*by).agg(F.round(100.0 - mean * 100.0, 6).alias(name))


def asof_grid(samples: DataFrame, keys: list[str], start: int, end: int, step_s: int = STEP_S,
              lookback_s: int = LOOKBACK_S, t: str = "t", value: str = "value",
              chunk_s: int = CHUNK_S) -> DataFrame:
    """The latest sample at or before every grid time, unless older than the look-back.

    Only the last sample of each grid cell can be seen from the grid, so cells
    are reduced first. A sample then covers the grid times up to the next one;
    that needs its neighbour only, not a join of the grid with the samples.
    Grid times without a sample give no row.
    """
    cells = (
        samples.filter((F.col(t) > start - lookback_s) & (F.col(t) <= end))
        .withColumn("__cell", grid_cell(F.col(t) - start, step_s) + start)
        .groupBy(*keys, "__cell")
        .agg(F.max(t).alias("sample_t"), F.max_by(value, t).alias(value))
    )
    paired = ordered_scan(cells, keys, "__cell", following={"__next": F.col("__cell")},
                          chunk_s=chunk_s)
    # Look-back is left-open: a sample exactly that old is no longer seen.
    oldest = F.floor((F.col("sample_t") + F.lit(lookback_s - 1 - start)) / F.lit(step_s)) * step_s + start
    last = F.least(F.coalesce(F.col("__next") - step_s, oldest), oldest, F.lit(_last(start, end, step_s)))
    first = F.greatest(F.col("__cell"), F.lit(start))
    return (
        paired.withColumn("__first", first.cast("bigint")).withColumn("__last", last.cast("bigint"))
        .filter(F.col("__first") <= F.col("__last"))
        .select(*keys, F.explode(F.sequence("__first", "__last", F.lit(step_s).cast("bigint")))
                .alias(t), "sample_t", value)
    )


def _last(start: int, end: int, step_s: int) -> int:
    return start + (end - start) // step_s * step_s


def staleness(df: DataFrame, keys: list[str], t: str, as_of: int, limit_s: int) -> DataFrame:
    """Age of the newest row per key and whether it exceeds the limit."""
    age = F.lit(as_of) - F.col("last_t")
    return df.groupBy(*keys).agg(F.max(t).alias("last_t")) \
        .withColumn("age_s", age.cast("bigint")).withColumn("stale", F.col("age_s") > limit_s)


def no_activity(increases: DataFrame, name: str = "increase") -> DataFrame:
    """Grid times at which a series did not grow."""
    return increases.filter(F.col(name) == 0)


def series_table(samples: DataFrame, keys: list[str], windows: list[int], start: int, end: int,
                 step_s: int = STEP_S, lookback_s: int = LOOKBACK_S, t: str = "t",
                 value: str = "value") -> DataFrame:
    """All that rules read of a series, a row per series and grid time.

    ``value`` and ``sample_t`` of the latest sample (null once that is older than
    the look-back), and ``grown_<w>``, the reset-aware growth over each window.
    One scan gives the growth since the sample before; samples are reduced to
    cells, whose last value and running growth stand until the next cell. The
    growth over a window is then the difference of two looks at that line, at
    the grid time and a window earlier, and every look is sent to the grid time
    that asks for it: one aggregation for any number of windows, of any width.
    """
    cell = gcd(step_s, *windows)
    widest = max(windows, default=0)
    first = start - -(-widest // cell) * cell
    cells = (
        counter_deltas(samples.select(*keys, t, value), keys, t, value)
        .filter(F.col(t) <= end)
        .withColumn("__cell", F.greatest(grid_cell(F.col(t) - start, cell) + start, F.lit(first)).cast("bigint"))
        .groupBy(*keys, "__cell")
        .agg(F.sum("delta").alias("__grew"), F.max(t).alias("sample_t"), F.max_by(value, t).alias(value))
    )
    line = ordered_scan(cells, keys, "__cell", running={"__total": F.col("__grew")}, prev={"__before": F.col("__cell")},
                        following={"__next": F.col("__cell")}, chunk_s=86400)
    # A cell stands until the next one; before a series' first there was no growth and no value.
    until = F.coalesce(F.col("__next") - cell, F.lit(_last(start, end, cell))).cast("bigint")
    own = F.struct(F.col("__cell").alias("__low"), until.alias("__high"), "__total", "sample_t", value)
    early = F.when(F.col("__before").isNull() & (F.col("__cell") > first), F.struct(
        F.lit(first).cast("bigint").alias("__low"), (F.col("__cell") - cell).alias("__high"), F.lit(0.0).alias("__total"),
        F.lit(None).cast("bigint").alias("sample_t"), F.lit(None).cast("double").alias(value)))
    spans = line.select(*keys, F.inline(F.array_compact(F.array(own, early)))).filter("__low <= __high")
    dense = spans.select(*keys, "__total", "sample_t", value, F.explode(
        F.sequence("__low", "__high", F.lit(cell).cast("bigint"))).alias("__at"))
    looks = dense.select(*keys, "__total", "sample_t", value, "__at", F.explode(F.array(*[
        F.lit(w).cast("bigint") for w in (0, *windows)])).alias("__ago"))
    looks = looks.withColumn(t, F.col("__at") + F.col("__ago")).filter(
        (F.col(t) >= start) & (F.col(t) <= end) & ((F.col(t) - start) % step_s == 0))
    now = F.col("__ago") == 0
    fresh = now & (F.col("__at") - F.col("sample_t") < lookback_s)
    out = looks.groupBy(*keys, t).agg(
        F.max(F.when(fresh, F.col("sample_t"))).alias("sample_t"), F.max(F.when(fresh, F.col(value))).alias(value),
        F.max(F.when(now, F.col("__total"))).alias("__now"),
        *[F.max(F.when(F.col("__ago") == w, F.col("__total"))).alias(f"__then_{w}") for w in windows])
    return out.select(*keys, t, "sample_t", value, *[
        (F.col("__now") - F.col(f"__then_{w}")).alias(f"grown_{w}") for w in windows])


def _rate(window_s: int) -> Column:
    return F.round(F.col(f"grown_{window_s}") / float(window_s), 9)


@dataclass(frozen=True)
class Recording:
    """A derived series.

    ``kind`` is rate (of ``metric``), ratio (of the rates of ``metric`` and
    ``other``), percent (the same in percent), busy (from the rates of an idle counter, across all series) or
    used (percent, from the gauges ``metric`` for the total and ``other`` for
    what is free).
    """

    record: str
    kind: str
    metric: str
    other: str | None = None


#: The derived series of the monitoring configuration (fixed values).
RECORDINGS = [
    Recording("reddit:posts_processed_rate", "rate", "posts_processed_total"),
    Recording("reddit:sentiment_analysis_rate", "rate", "sentiment_analyses_total"),
    Recording("reddit:api_error_rate", "rate", "reddit_api_errors_total"),
    Recording("reddit:duplication_rate", "ratio", "duplicates_found_total", "posts_fetched_total"),
    Recording("system:cpu_usage", "busy", "node_cpu_seconds_total"),
    Recording("system:memory_usage", "used", "node_memory_MemTotal_bytes",
              "node_memory_MemAvailable_bytes"),
    Recording("system:disk_usage", "used", "node_filesystem_size_bytes",
              "node_filesystem_free_bytes"),
]


#: Percent of fetched posts that were duplicates, which a rule compares.
DUPLICATION = Recording("duplication_percent", "percent", "duplicates_found_total", "posts_fetched_total")


def _inputs(rules: list[Recording]) -> list[str]:
    return sorted({m for r in rules for m in (r.metric, r.other) if m})


def _recorded(table: DataFrame, rules: list[Recording], keys: list[str], window_s: int) -> DataFrame:
    """The derived series ``(record, keys..., t, value)`` of a :func:`series_table` with that window.

    Each row goes to the records it is part of; both parts of a record meet in one group.
    """
    gauge = F.col("value").cast("decimal(30,9)")
    roles = [F.when(F.col("metric") == m, F.struct(
        F.lit(r.record).alias("record"), F.lit(first).alias("__first"),
        (gauge if r.kind == "used" else _rate(window_s).cast("decimal(30,9)")).alias("__v"),
        *[(F.lit("") if r.kind == "busy" else F.col(k).cast("string")).alias(f"__{k}") for k in keys]))
        for r in rules for m, first in ((r.metric, True), (r.other, False)) if m]
    rows = table.select("t", F.inline(F.array_compact(F.array(*roles)))).filter(F.col("__v").isNotNull())
    one = F.col("__first")
    out = rows.groupBy("record", *[F.col(f"__{k}").alias(k) for k in keys], "t").agg(
        F.sum(F.when(one, F.col("__v"))).cast("double").alias("__a"),
        F.sum(F.when(~one, F.col("__v"))).cast("double").alias("__b"),
        F.count_if(one).alias("__n"))
    a, b = F.col("__a"), F.col("__b")
    made = {
        "rate": a,
        "ratio": F.round(F.try_divide(a, b), 6),
        "percent": F.round(F.try_divide(a, b) * 100.0, 6),
        "busy": F.round(100.0 - F.try_divide(a, F.col("__n").cast("double")) * 100.0, 6),
        "used": F.round(F.try_divide(a - b, a) * 100.0, 6),
    }
    result = F.lit(None).cast("double")
    both = F.lit(False)
    for r in rules:
        mine = F.col("record") == r.record
        result = F.when(mine, made[r.kind]).otherwise(result)
        both = both | mine if r.other is None else both | (mine & a.isNotNull() & b.isNotNull())
    return out.filter(both).select("record", *keys, "t", result.alias("value"))


def recording_rules(samples: DataFrame, rules: list[Recording], keys: list[str], start: int,
                    end: int, step_s: int = STEP_S, window_s: int = 300,
                    lookback_s: int = LOOKBACK_S) -> DataFrame:
    """All derived series as ``(record, keys..., t, value)`` on the grid.

    ``samples`` are ``(metric, keys..., t, value)``; ``node_cpu_seconds_total``
    holds idle time. Rates and gauges come from one :func:`series_table`.
    Written with ``partitionBy('record')`` this is the materialised form of the
    rules.
    """
    mine = samples.filter(F.col("metric").isin(_inputs(rules)))
    table = series_table(mine, ["metric", *keys], [window_s], start, end, step_s, lookback_s)
    return _recorded(table, rules, keys, window_s)


def rule_series(samples: DataFrame, rules: list[tuple], keys: list[str], start: int, end: int,
                step_s: int = STEP_S, lookback_s: int = LOOKBACK_S,
                recordings: list[Recording] | None = None, window_s: int = 300) -> DataFrame:
    """What the rules compare, on the grid: ``(metric, func, window_s, keys..., t, value)``.

    ``rules`` are rows of ``RULE_SCHEMA``; ``func`` is value, age (time since
    the value, a timestamp), increase or rate. All functions and windows, and
    those of the ``recordings`` (derived over ``window_s``) whose records a rule
    reads, come from one :func:`series_table`.
    """
    derived = [r for r in (recordings or []) if r.record in {rule[1] for rule in rules}]
    reads = sorted({(rule[1], rule[2], rule[3]) for rule in rules})
    windows = sorted({w for _, func, w in reads if func in ("increase", "rate")} | ({window_s} if derived else set()))
    mine = samples.filter(F.col("metric").isin(sorted({m for m, _, _ in reads} | set(_inputs(derived)))))
    table = series_table(mine, ["metric", *keys], windows, start, end, step_s, lookback_s)
    if derived:
        table = staged(table, "series")

    def read(func: str, window: int) -> Column:
        if func == "increase":
            return F.col(f"grown_{window}")
        if func == "rate":
            return _rate(window)
        return F.col("t") - F.col("value") if func == "age" else F.col("value")

    looks = [F.when(F.col("metric") == m, F.struct(F.lit(func).alias("func"), F.lit(w).cast("bigint").alias("window_s"),
                                                   read(func, w).cast("double").alias("value"))) for m, func, w in reads]
    out = table.select("metric", *keys, "t", F.inline(F.array_compact(F.array(*looks)))).filter(F.col("value").isNotNull()) \
        .select("metric", "func", "window_s", *keys, "t", "value")
    if derived:
        made = _recorded(table, derived, keys, window_s).select(
            F.col("record").alias("metric"), F.lit("value").alias("func"), F.lit(0).cast("bigint").alias("window_s"), *keys, "t", "value")
        out = out.unionByName(made.filter(F.col("value").isNotNull()))
    return out
