import random

import numpy as np
import pytest
from helpers import changed, clashing, frame, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import components as near_components
from tidemark.llm import near_duplicates
from tidemark.llm.common import WordHashes
from tidemark.llm.components import components
from tidemark.llm.near_duplicates import _kmers, classes, keep_first, matched, similar, words_of


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=30), st.lists(st.integers(0, 4), min_size=1, max_size=30),
       st.integers(0, 30))
def test_banded_alignment_loses_nothing(a, b, least):
    want = lcs(a, b)
    assert matched(np.array(a, np.uint64), np.array(b, np.uint64), least) == (want if want >= least else 0)


def brute(rows, threshold=0.8):
    """Class of every (id, text) by comparing all pairs."""
    hashes, firsts = WordHashes(), {}
    for r in rows:
        if r[0] is not None and r[1] is not None and words_of(r[1].encode()):
            firsts.setdefault(r[0], set()).add(r[1])
    import hashlib

    text = {i: min(ts, key=lambda t: hashlib.sha256(t.encode()).hexdigest()) for i, ts in firsts.items()}
    kmers = {i: _kmers([t.encode()], hashes, 5)[0] for i, t in text.items()}
    root = {i: i for i in text}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in text:
        for b in text:
            if a < b:
                m = lcs(kmers[a].tolist(), kmers[b].tolist())
                if text[a] == text[b] or m / (len(kmers[a]) + len(kmers[b]) - m) >= threshold:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return sorted(((r[0], find(r[0]) if r[0] in root and r[1] is not None and words_of(r[1].encode()) else r[0])
                   for r in rows), key=str)


def corpus():
    rows = [r for r in odd_rows() if r[0] != 11]
    base, rng = words(150, 40), random.Random(4)
    rows.append((100, base, "en", "a", 1))
    # Copies edited apart: near to their source, not to each other.
    for i in range(24):
        edited = base.split()
        for j in rng.sample(range(150), 2):
            edited[j] = f"e{i}x{j}"
        rows.append((101 + i, " ".join(edited), "en", "a", 1))
    for i in range(12):  # a common opening, nothing else
        rows.append((200 + i, words(12, 99) + " " + words(60, 300 + i), "en", "b", 1))
    rows += [(300, words(80, 50), "en", "b", 1), (301, changed(words(80, 50), 5), "en", "b", 1),
             (302, "a b c", "en", "b", 1), (303, "A, b: C!", "en", "b", 1), (304, "a b", "en", "b", 1)]
    return rows


def test_classes_equal_all_pairs(spark):
    rows = corpus()
    got = classes(clashing(frame(spark, rows))).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def revisions(count, step, seed=70):
    """Equally long texts, each near to the next one alone, with shuffled ids."""
    text, rng = words(200, seed).split(), random.Random(seed)
    ids = rng.sample(range(1000, 1000 + count), count)
    places = rng.sample(range(200), 200)
    rows = []
    for i, doc_id in enumerate(ids):
        rows.append((doc_id, " ".join(text), "en", "a", 1))
        for j in range(step):
            text[places[(i * step + j) % 200]] = f"r{i}x{j}"
    return rows


@pytest.mark.parametrize("cell", [256, 4])
def test_a_chain_of_revisions_is_one_class(spark, monkeypatch, cell):
    monkeypatch.setattr(near_duplicates, "CELL_TEXTS", cell, raising=False)
    rows = revisions(40, 4) + corpus()
    got = classes(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_keep_first(spark):
    rows = corpus()
    docs = clashing(frame(spark, rows))
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted({i for i, c in brute(rows) if i == c and i is not None})
    assert got.count(None) == 2


def test_no_rows(spark):
    assert classes(frame(spark, [])).collect() == [] and keep_first(frame(spark, [])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 60)]
    pairs += [(rng.randrange(2000, 2060), rng.randrange(2000, 2060)) for _ in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.id: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert {i: find(i) for i in root if find(i) != i} == {i: r for i, r in got.items() if i != r}


def test_rounds_over_few_links_take_few_tasks(spark, monkeypatch):
    files, real = [], near_components.written

    def counted(df, name):
        out = real(df, name)
        files.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(near_components, "written", counted)
    held = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        pairs = [(i, i + 1) for i in range(0, 200, 2)]
        got = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got)) == [(b, a) for a, b in pairs]
    # Pairs are stars from the start: no round is spent on finding that out.
    assert [name for name, _ in files] == ["links", "least"]
    assert files[1][1] <= spark.sparkContext.defaultParallelism


def test_texts_of_unjoined_buckets_are_marked_once(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CELL_TEXTS", 4)
    calls, real = [], near_duplicates._marked
    monkeypatch.setattr(near_duplicates, "_marked", lambda *a: calls.append(1) or real(*a))
    rows = revisions(40, 4) + corpus()
    got = classes(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows) and len(calls) == 1


def test_similarity_threshold():
    a = np.arange(90, dtype=np.uint64)
    b = a.copy()
    b[:10] += np.uint64(1000)
    assert similar(a, b, 80 / 100) and not similar(a, b, 80 / 99)
