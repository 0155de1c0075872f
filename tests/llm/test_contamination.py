import random
import re

from helpers import clashing, frame, odd_rows

from tidemark.llm.contamination import clean, digests, find_passages

ITEMS = "item_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, width):
    windows = {}
    for i, t in items:
        ws = split(t)
        for s in range(max(1, len(ws) - width + 1) if ws and i is not None else 0):
            windows.setdefault(tuple(ws[s:s + width]), set()).add(str(i))
    out = []
    for r in rows:
        ws, hit, found = split(r[1]), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(ws) - size + 1):
                if (own := windows.get(tuple(ws[s:s + size]))):
                    hit.update(range(s, s + size))
                    found |= own
        out.append((r[0], len(ws), len(hit), sorted(found)))
    return sorted(out, key=str)


def got(found):
    return sorted(((r.row["doc_id"], r.n_words, sum(b - a for a, b in r.spans), r["items"]) for r in found.collect()), key=str)


def test_odd_rows_and_items(spark):
    rows = odd_rows()
    long = rows[0][1].split()
    items = [(1, " ".join(long[30:52]).upper()), (2, "ÜBER äpfel"), (3, None), (4, ""), (5, "?"), (None, "x"), (6, "X"),
             (7, " ".join(long[:9]) + " other " + " ".join(long[9:30])), (7, " ".join(long[100:112]))]
    for block in (1 << 20, 40):  # one block, and a pass per item
        found = find_passages(clashing(frame(spark, rows)), spark.createDataFrame(items, ITEMS), 10, block)
        assert got(found) == brute(rows, items, 10)


def test_repetitive_texts(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b", "zz"]) for _ in range(rng.randint(0, 200))), None, None, None) for i in range(80)]
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 14)))) for i in range(30)]
    assert got(find_passages(frame(spark, rows), spark.createDataFrame(items, ITEMS), 6)) == brute(rows, items, 6)


def test_digest_and_clean(spark):
    rows = odd_rows()
    items = spark.createDataFrame([(3, rows[9][1])], ITEMS)
    out = {(r.doc_id, r.n_words): r for r in digests(find_passages(frame(spark, rows), items)).collect()}
    assert out[8, 90].contaminated and out[8, 90].n_hit == 90 and not out[8, 70].contaminated
    kept = clean(clashing(frame(spark, rows)), items)
    assert kept.columns == clashing(frame(spark, rows)).columns and kept.count() == len(rows) - 2


def test_empty_tables(spark):
    items = spark.createDataFrame([], ITEMS)
    assert all(not r.spans for r in find_passages(frame(spark, odd_rows()), items).collect())
    assert find_passages(frame(spark, []), items).collect() == []
