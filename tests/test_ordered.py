"""The chunked scans against plain loops, whatever the chunk width."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordered import first_per_key, ordered_scan, range_sum, top_n

SCHEMA = "k string, t bigint, id bigint, v double"


def _rows(seed, n=300, span=5000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # One series holds most of the rows; one has no name.
        k = rnd.choice(["hot"] * 6 + ["a", "b", None])
        v = None if rnd.random() < 0.3 else float(rnd.randint(-5, 9))
        rows.append((k, rnd.randint(-span // 4, span), i, v))
    return rows


def _expected(rows):
    out = {}
    for k in {r[0] for r in rows}:
        line = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))
        total, held = 0.0, None
        for i, (_, _, ident, v) in enumerate(line):
            prior = held
            if v is not None:
                total, held = total + v, v
            out[ident] = (line[i - 1][3] if i else None,
                          line[i + 1][3] if i + 1 < len(line) else None, held, prior, total)
    return out


@pytest.mark.parametrize("chunk_s,block", [(1, None), (60, None), (700, None), (100_000, None),
                                           (60, 7)])
def test_scan(spark, chunk_s, block):
    rows = _rows(chunk_s)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    v = F.col("v")
    got = ordered_scan(df, ["k"], "t", ["id"], prev={"p": v}, following={"n": v}, fill={"f": v},
                       prior={"q": v}, running={"s": v}, chunk_s=chunk_s, block=block).collect()
    assert len(got) == len(rows)
    want = _expected(rows)
    for r in got:
        assert (r.p, r.n, r.f, r.q, r.s) == want[r.id], r


def test_scan_with_block_splits_one_second(spark):
    """All rows of a series in the same second."""
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(5).cast("bigint").alias("t"), "id",
                                  F.lit(1.0).alias("v"))
    got = ordered_scan(df, ["k"], "t", ["id"], running={"s": F.col("v")}, block=64)
    assert got.filter(F.col("s") != F.col("id") + 1).count() == 0


@pytest.mark.parametrize("window_s", [1, 50, 1000])
def test_range_sum(spark, window_s):
    rnd = random.Random(window_s)
    rows = [(k, t, float(rnd.randint(0, 9))) for k in "ab"
            for t in rnd.sample(range(-500, 3000), 200)]
    df = spark.createDataFrame(rows, "k string, t bigint, v double")
    got = range_sum(df, ["k"], "t", "v", window_s, "s").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.s == sum(v for k, t, v in rows if k == r.k and r.t - window_s < t <= r.t)


def test_top_n_and_first(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 5}", rnd.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(6)
    got = {}
    for r in top_n(df, ["k"], [F.desc("v"), F.col("id")], ["id"], 7).collect():
        got.setdefault(r.k, {})[r["rank"]] = r.id
    for k in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))[:7]
        assert got[k] == {i + 1: r[2] for i, r in enumerate(best)}
    first = {r.k: r.id for r in first_per_key(df, ["k"], [F.col("id")]).collect()}
    assert first == {k: min(r[2] for r in rows if r[0] == k) for k in first}
