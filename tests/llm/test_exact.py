import hashlib
from collections import defaultdict

import pytest
from helpers import clashing, frame, odd_rows
from pyspark.sql import functions as F

from tidemark.llm.exact import keep_one, leaves, mark_copies, merge_tree


def brute(rows, largest=True, change=lambda t: t):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[change(r[1] or "")].append((r[0], i))
    out = []
    for text, members in groups.items():
        known = [d for d, _ in members if d is not None]
        keep = (max(known) if largest else min(known)) if known else None
        stays = next(i for d, i in members if d == keep)
        out += [(d, keep, len(members), i == stays, hashlib.sha256(text.encode()).hexdigest()) for d, i in members]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("parts", [1, 3, 40])
def test_odd_rows(spark, parts, largest):
    rows = odd_rows()
    assert got(mark_copies(clashing(frame(spark, rows, parts=parts)), largest=largest)) == brute(rows, largest)


def test_a_hot_text_and_several_rounds(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i // 2}", "en", "a", 1) for i in range(600)] + \
        [(9_000 + i, "long " * 20_000, "en", "a", 1) for i in range(3)]
    docs = frame(spark, rows, parts=37)
    assert got(mark_copies(docs, fan_in=3)) == brute(rows)
    rounds = merge_tree(leaves(docs), fan_in=3)
    assert len(rounds) == 5 and rounds[-1].agg(F.max("run"), F.sum("n")).first() == (0, 603)
    # No run has a text twice, so a round moves at most fan_in rows of one text to a task.
    assert all(r.groupBy("run", "digest").count().agg(F.max("count")).first()[0] == 1 for r in rounds)


def test_texts_that_share_a_digest_stay_apart(spark):
    """As if SHA-256 had met a collision."""
    rows = spark.createDataFrame([(0, 5, 1, b"d", 3, 7), (1, 6, 2, b"d", 3, 7), (1, 7, 3, b"d", 3, 8), (2, 8, 4, b"d", 4, 7)],
                                 "run int, place bigint, id bigint, digest binary, size int, check bigint")
    last = merge_tree(rows)[-1].collect()
    assert sorted((r.size, r.check, r.best.rank, r.n) for r in last) == [(3, 7, 2, 2), (3, 8, 3, 1), (4, 7, 4, 1)]


def test_normaliser_and_rows_that_stay(spark):
    rows = odd_rows() + [(20, "A b", "en", "a", 1), (21, "a B", "en", "a", 1)]
    docs = clashing(frame(spark, rows))
    marked = mark_copies(docs, normalise=F.lower)
    assert got(marked) == brute(rows, change=str.lower)
    kept = keep_one(docs, normalise=F.lower)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, (r.doc_id for r in marked.filter("kept").collect())))


def test_empty_table(spark):
    assert mark_copies(frame(spark, [])).collect() == [] and keep_one(frame(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = mark_copies(frame(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_ids_of_other_types(spark):
    rows = [(1, "x"), (2, "x"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert got(mark_copies(docs)) == brute(rows)
