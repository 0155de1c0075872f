import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup

POSTS = [("1", "Bitcoin", "up", "Bitcoin", 100, 0), ("2", "Ether", "down", "ethereum", 200, 1),
         ("3", "Bitcoin", "up", "Bitcoin", 300, 2)]
SCHEMA = ("post_id string, title string, content string, subreddit string, created_utc bigint, "
          "arrival_seq bigint")


def test_first_of_three_is_kept(spark):
    df = dedup.with_hash(spark.createDataFrame(POSTS, SCHEMA))
    assert sorted(r.post_id for r in dedup.dedup_first_wins(df).collect()) == ["1", "2"]


def test_missing_fields(spark):
    rows = [("1", "t", None, None, None, 0), ("2", None, "c", None, None, 1),
            ("3", "", "", None, None, 2), ("4", None, None, None, None, 3)]
    df = dedup.with_hash(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.post_id for r in dedup.dedup_first_wins(df).collect()) == ["1", "2", "3"]
    stored = dedup.store_rows(df).collect()
    assert {(r.title, r.subreddit, r.created_utc, r.first_seen_utc) for r in stored} == {
        ("t", "", 0, 0), ("", "", 0, 0)}


def test_flag_keeps_all_rows(spark):
    df = dedup.with_hash(spark.createDataFrame(POSTS, SCHEMA))
    store = df.filter("post_id = '2'").select("content_hash")
    got = {r.post_id: r.is_duplicate for r in dedup.duplicate_flag(df, store).collect()}
    assert got == {"1": False, "2": True, "3": True}


def test_insert_checks_hash_and_id(spark):
    df = dedup.with_hash(spark.createDataFrame(POSTS + [("1", "other", "", "x", 5, 3)], SCHEMA))
    empty = dedup.store_rows(df).limit(0)
    first = dedup.insert_if_absent(df, empty)
    assert sorted(r.post_id for r in first.collect()) == ["1", "2"]
    assert dedup.insert_if_absent(df, first).count() == 0


def test_stats(spark):
    store = dedup.store_rows(dedup.with_hash(spark.createDataFrame(POSTS, SCHEMA)))
    assert tuple(dedup.store_stats(store).first()) == (3, 100, 300)
    assert [tuple(r) for r in dedup.store_by_community(store).collect()] == [
        ("Bitcoin", 2), ("ethereum", 1)]


def _sequential(rows, ids, hashes):
    """Emit unless the hash is stored; store unless hash or id is."""
    ids, hashes, out = set(ids), set(hashes), []
    for seq, ident, h in sorted(rows):
        if h in hashes:
            continue
        out.append(seq)
        if ident not in ids:
            ids.add(ident)
            hashes.add(h)
    return out, hashes


@pytest.mark.parametrize("seed", range(4))
def test_strict_equals_the_loop(spark, seed):
    rnd = random.Random(seed)
    ids, texts = [(5, 5), (20, 8), (8, 30), (60, 60)][seed]
    rows = [(i, rnd.choice(["", f"i{rnd.randrange(ids)}"]), f"h{rnd.randrange(texts)}")
            for i in range(150)]
    known = [("i1", "h1"), ("i2", "old")] if seed % 2 else []
    df = spark.createDataFrame(rows, "arrival_seq bigint, post_id string, content_hash string")
    store = spark.createDataFrame(known, "post_id string, content_hash string")
    emitted, stored = dedup.dedup_strict(df, store)
    want, hashes = _sequential(rows, [k[0] for k in known], [k[1] for k in known])
    assert sorted(r.arrival_seq for r in emitted.collect()) == want
    assert {r.content_hash for r in stored.collect()} | {k[1] for k in known} == hashes


def test_strict_with_one_hash_per_id_is_first_wins(spark):
    df = dedup.with_hash(spark.createDataFrame(POSTS, SCHEMA))
    emitted, _ = dedup.dedup_strict(df)
    assert sorted(r.post_id for r in emitted.collect()) == ["1", "2"]
