import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import clashing, frame, odd_rows, words

from tidemark.llm import ranked
from tidemark.llm.common import small_batches
from tidemark.llm.ranked import build_index, impacts, search

ITEMS = "item_id bigint, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]


def brute(rows, items, k=10):
    docs = [(r[0], Counter(split(r[1]))) for r in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    wanted = defaultdict(Counter)
    for i, t in items:
        wanted[i].update(split(t))
    out = []
    for i, terms in wanted.items():
        scores = []
        for d, c, n in docs:
            m = 100 - 75 + 75 * n * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, q in terms.items() if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(rows):
    base = rows[0][1].split(" ")
    return [(1, " ".join(base[5:40])), (2, "ÜBER äpfel, über und"), (3, None), (4, ""), (5, "?"), (None, base[3]),
            (6, "x X x"), (7, base[1]), (7, " ".join(base[20:24])), (8, "nowhere at all"), (9, rows[14][1])]


@pytest.mark.parametrize("segment", [1 << 20, 3000])
@pytest.mark.parametrize("block", [1 << 20, 40])
def test_odd_rows_and_items(spark, segment, block):
    rows = odd_rows()
    index = build_index(clashing(frame(spark, rows)), segment)
    items = clashing(spark.createDataFrame(items_of(rows), ITEMS))
    assert got(search(index, items, 10, block)) == brute(rows, items_of(rows))
    assert got(search(index, items, 2, block)) == brute(rows, items_of(rows), 2)


@pytest.mark.parametrize("at_once", [1, 16])
def test_random_texts_with_many_copies(spark, monkeypatch, at_once):
    """Ties of hundreds of copies: the smallest ids stay, in every order of opening."""
    monkeypatch.setattr(ranked, "AT_ONCE", at_once)
    rng = random.Random(5)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    rows = [(i, "hot text w1 w2 w7", "en", "a", 1) for i in rng.sample(range(3000), 400)]
    rows += [(3000 + i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60))), "en", "a", 1) for i in range(600)]
    rng.shuffle(rows)
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for i in range(30)] + [(30, "hot w7"), (31, "text")]
    index = build_index(frame(spark, rows, parts=5), 20_000)
    assert got(search(index, spark.createDataFrame(items, ITEMS))) == brute(rows, items)


def test_a_document_with_every_other_term_is_found_first():
    """What the method is for: bounds close most intervals unopened, and range maxima equal brute force."""
    rng = np.random.default_rng(1)
    sizes = np.array([700, 300, 300, 31, 2, 1])
    places = np.concatenate([np.sort(rng.choice(1000, n, replace=False)) for n in sizes]).astype(np.int64)
    values = rng.integers(0, 50, len(places))
    postings = ranked.Postings(places, values, sizes)
    for n, a in zip(sizes.tolist(), postings.starts.tolist()):
        for _ in range(200):
            low, high = sorted(rng.integers(a, a + n + 1, 2).tolist())
            if low < high:
                best = int(postings.best(np.array([low]), np.array([high]))[0])
                assert low <= best < high and values[best] == values[low:high].max()
    ids = np.arange(1000)
    planted = values.copy()
    planted[postings.starts[:3]] = 10_000
    leaders = ranked.Leaders(1, 1)
    found = ranked.Search(ranked.Postings(places, planted, sizes), ids, leaders)
    found.run(np.zeros(1, np.int64), np.arange(6), postings.starts, postings.starts + sizes, np.ones(6, np.int64), np.array([6]))
    total = np.bincount(places, planted, 1000)
    assert leaders.scores[0, 0] == total.max() and leaders.ids[0, 0] == total.argmax() and found.opened < 100


def test_items_are_searched_some_at_a_time(monkeypatch):
    """What a task holds follows the terms searched together, not the items of a block."""
    monkeypatch.setattr(ranked, "ENTRIES", 50, raising=False)
    most, bounded = [], ranked.Search._bounded

    def watched(self, item, first, lists, *rest):
        most.append(len(lists))
        return bounded(self, item, first, lists, *rest)

    monkeypatch.setattr(ranked.Search, "_bounded", watched)
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(90)}" for _ in range(40))) for i in range(60)]
    items = [(i, " ".join(f"w{rng.randrange(90)}" for _ in range(n))) for i, n in enumerate([20] * 200 + [200])]
    segment = ranked._segment(np.arange(60), np.ones(60, bool), [t.encode() for _, t in rows])
    documents, vocabulary, postings = (ranked._unpacked(segment[c][0]) for c in ("documents", "vocabulary", "postings"))
    block = ranked.Block({i: [t.encode()] for i, t in items})
    terms = [split(t) for _, t in rows]
    df = [sum(w in own for own in terms) for w in block.vocabulary]
    weights = np.array([math.floor(1000 * math.log(122 / (2 * n + 1))) for n in df])
    leaders = ranked.Leaders(201, 10)
    ids, lengths = (x.to_numpy() for x in documents)
    ranked._opened((ids, np.ones(60, bool), lengths, vocabulary[0], vocabulary[1].to_numpy(), *(x.to_numpy() for x in postings)),
                   block, weights, 60, sum(map(len, terms)), leaders)
    found = [(items[i][0], r + 1, int(leaders.ids[i, r]), int(leaders.scores[i, r])) for i, r in zip(*np.nonzero(leaders.scores))]
    assert sorted(found, key=str) == brute(rows, items)
    assert max(most) <= 2 * ranked.AT_ONCE * 80


def test_products_over_64_bits():
    lengths, counts = np.array([5, 10**8]), np.array([2, 3])
    wide = impacts(counts, lengths, 10**12, 10**15)
    assert wide.tolist() == [10**9 * c // (1000 * c + 8 * (25 + 75 * n * 10**12 // 10**15)) for c, n in zip([2, 3], [5, 10**8])]


def test_an_index_is_written_and_read_in_small_parts(spark, monkeypatch):
    """Neither the Parquet writer nor a reader's or a task's batch holds many segments at once."""
    monkeypatch.setitem(ranked.ROW_GROUPS, "parquet.block.size", 1000)
    rows = [(i, words(300, i), "en", "a", 1) for i in range(40)]
    index = build_index(frame(spark, rows, parts=2), 2000)
    files = [pq.ParquetFile(re.sub("^file:/+", "/", f)).metadata for f in index.inputFiles()]
    assert sum(f.num_rows for f in files) == sum(f.num_row_groups for f in files) == 40

    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"n": pa.array([b.num_rows], pa.int64()), "size": pa.array([b.nbytes], pa.int64())})

    seen = index.coalesce(1).mapInArrow(sizes, "n bigint, size bigint")
    with small_batches(spark, 1000):
        assert [r.n for r in seen.collect()] == [1] * 40
    assert [r.n for r in seen.collect()] == [40]


def test_a_very_long_text(spark):
    rows = [(1, words(200_000, 3), "en", "a", 1), (2, words(50, 4), "en", "a", 1), (3, words(80, 3), "en", "a", 1)]
    items = [(1, " ".join(rows[0][1].split(" ")[150_000:150_040]))]
    assert got(search(build_index(frame(spark, rows), 4000), spark.createDataFrame(items, ITEMS))) == brute(rows, items)


def test_empty_tables(spark):
    some, none = spark.createDataFrame([(1, "a")], ITEMS), spark.createDataFrame([], ITEMS)
    for rows in ([], [(1, "?", "en", "a", 1), (2, None, "en", "a", 1)]):
        assert search(build_index(frame(spark, rows)), some).collect() == []
    found = search(build_index(frame(spark, odd_rows())), none)
    assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]
