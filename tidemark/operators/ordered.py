"""Ordered scans over long series, split by time.

A plain ``Window.partitionBy(series).orderBy(t)`` puts one whole series into
one task, however long it is. The scans here cut every series into time chunks
that are windowed independently. What a chunk needs from its neighbours comes
from a summary of one row per (series, chunk), made with map-side combine; it
is put in as an extra row at the edge of the chunk, so that the window sees it
in place and rows are shuffled once and never joined.

Choose the chunk so that one series cannot fill it: an hour holds at most 3,600
collapsed samples, but any number of raw events, for which a minute is the
default. Where even one second of one series is too much for a task, ``block``
cuts the seconds by ranges of the first tie column as well.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

#: Chunk widths in seconds: for series with one row per second at most, and for raw events.
CHUNK_S = 3600
EVENT_CHUNK_S = 60

_CHUNK, _BLOCK, _EDGE = "__chunk", "__block", "__edge"


def _chunk_of(t: Column, width: int) -> Column:
    return F.floor(t / F.lit(width)).cast("bigint")


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    t: str,
    tie: list[str] | None = None,
    *,
    prev: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    fill: dict[str, Column] | None = None,
    prior: dict[str, Column] | None = None,
    running: dict[str, Column] | None = None,
    chunk_s: int = CHUNK_S,
    block: int | None = None,
) -> DataFrame:
    """Add ordered columns to ``df`` with one shuffle of its rows.

    Per ``keys``, in order of ``t`` and ``tie``, which must identify a row:

    - ``prev`` / ``following``: the value of the row before / after;
    - ``fill``: the last non-null value up to and with this row;
    - ``prior``: the last non-null value before this row;
    - ``running``: the sum up to and with this row.

    With ``block`` the chunks are single seconds cut every ``block`` values of
    the first (integral) tie column.
    """
    tie = tie or []
    prev, following = prev or {}, following or {}
    fill, prior, running = fill or {}, prior or {}, running or {}
    wanted = {**prev, **following, **fill, **prior, **running}
    ins = {name: f"__in_{name}" for name in wanted}

    if block is None:
        cut, cuts = [_CHUNK], [_chunk_of(F.col(t), chunk_s).alias(_CHUNK)]
    else:
        cut = [_CHUNK, _BLOCK]
        cuts = [F.col(t).alias(_CHUNK), _chunk_of(F.col(tie[0]), block).alias(_BLOCK)]
    rows = df.select("*", *cuts, *[c.alias(ins[n]) for n, c in wanted.items()],
                     F.lit(0).alias(_EDGE))
    place = row_place(df, t, tie)

    # One row per (series, chunk): its last, first, last non-null and summed values.
    parts = [F.max_by(ins[name], place).alias(name) for name in prev]
    parts += [F.min_by(ins[name], place).alias(name) for name in following]
    parts += [F.max_by(ins[name], F.when(F.col(ins[name]).isNotNull(), place)).alias(name)
              for name in [*fill, *prior]]
    parts += [F.sum(ins[name]).alias(name) for name in running]
    summary = rows.groupBy(*keys, *cut).agg(*parts)

    over = Window.partitionBy(*keys).orderBy(*cut)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carry = {name: F.lag(name).over(over) for name in prev}
    carry |= {name: F.last(name, ignorenulls=True).over(before) for name in [*fill, *prior]}
    carry |= {name: F.sum(name).over(before) for name in running}
    kinds = {f.name: f.dataType for f in rows.schema}

    def edge(values: dict[str, Column], side: int) -> DataFrame:
        """The carried values as rows before (-1) or after (1) their chunk."""
        carried = summary.select(*keys, *cut, *[c.alias(n) for n, c in values.items()])
        held = {ins[n]: F.col(n).cast(kinds[ins[n]]) for n in values}
        held[_EDGE] = F.lit(side)
        return carried.select(*[
            F.col(c) if c in keys or c in cut
            else held.get(c, F.lit(None).cast(kind)).alias(c) for c, kind in kinds.items()])

    line = rows
    if carry:
        line = line.unionByName(edge(carry, -1))
    if following:
        line = line.unionByName(edge({n: F.lead(n).over(over) for n in following}, 1))

    inside = Window.partitionBy(*keys, *cut).orderBy(_EDGE, t, *tie)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = {name: F.lag(ins[name]).over(inside) for name in prev}
    out |= {name: F.lead(ins[name]).over(inside) for name in following}
    out |= {name: F.last(ins[name], ignorenulls=True).over(upto) for name in fill}
    out |= {name: F.last(ins[name], ignorenulls=True).over(earlier) for name in prior}
    out |= {name: F.coalesce(F.sum(ins[name]).over(upto), F.lit(0)) for name in running}
    return (line.select("*", *[c.alias(n) for n, c in out.items()])
            .filter(F.col(_EDGE) == 0).select(*df.columns, *out))


def row_place(df: DataFrame, t: str, tie: list[str]) -> Column:
    """A row's place in its series as one comparable value.

    Time and an integral tie are packed into a decimal, which the hash
    aggregation can hold; a struct would make Spark sort the rows instead.
    """
    if not tie:
        return F.col(t)
    if len(tie) == 1 and isinstance(df.schema[tie[0]].dataType, IntegralType):
        step = F.lit(Decimal(2 * 10**19)).cast("decimal(20,0)")
        return F.col(t).cast("decimal(18,0)") * step + F.col(tie[0]).cast("decimal(19,0)")
    return F.struct(t, *tie)


def range_sum(df: DataFrame, keys: list[str], t: str, value: str, window_s: int,
              name: str) -> DataFrame:
    """Sum of ``value`` over the left-open range ``(t - window_s, t]`` per series."""
    return range_sums(df, keys, t, {name: value}, window_s)


def range_sums(df: DataFrame, keys: list[str], t: str, values: dict[str, str],
               window_s: int) -> DataFrame:
    """Sums of several columns over the left-open range ``(t - window_s, t]`` per series.

    Every row goes to the chunk of its own time and to the next one as context,
    which is enough because a chunk is one window wide. A sum is the
    difference of two growing frames, so a row costs O(1) whatever the window.
    """
    own = _chunk_of(F.col(t), window_s)
    spread = df.withColumn("__own", own).withColumn(
        _CHUNK, F.explode(F.array(F.col("__own"), F.col("__own") + 1)))
    w = Window.partitionBy(*keys, _CHUNK).orderBy(t)
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    gone = w.rangeBetween(Window.unboundedPreceding, -window_s)
    sums = {n: F.sum(v).over(upto) - F.coalesce(F.sum(v).over(gone), F.lit(0)) for n, v in values.items()}
    return (
        spread.withColumns(sums)
        .filter(F.col(_CHUNK) == F.col("__own"))
        .select(*df.columns, *sums)
    )


def top_n(df: DataFrame, keys: list[str], order: list[Column], spread_by: list[str], n: int,
          rank: str = "rank", slices: int = 32) -> DataFrame:
    """First ``n`` rows per key, with their rank.

    Ranked first within slices of a key and then across them, so that a key
    holding much of the data is not sorted by one task. Spark also limits each
    group before the first shuffle.
    """
    sliced = df.withColumn("__slice", F.pmod(F.xxhash64(*spread_by), F.lit(slices)))
    local = Window.partitionBy(*keys, "__slice").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        sliced.withColumn("__r", F.row_number().over(local)).filter(F.col("__r") <= n)
        .drop("__r", "__slice")
        .withColumn(rank, F.row_number().over(final)).filter(F.col(rank) <= n)
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key. Spark keeps one row per key and map task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1).drop("__r")
