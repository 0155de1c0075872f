import random
import re

from helpers import clashing, frame, odd_rows

from tidemark.llm.substrings import remove_repeats


def brute(rows, length):
    """Words kept per row, by comparing every window with all that start earlier."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    place = [-1 if r[0] is None else r[0] for r in rows]
    first = {}
    for ws, p in zip(split, place):
        for s in range(len(ws) - length + 1):
            key = tuple(ws[s:s + length])
            first[key] = min(first.get(key, (p, s)), (p, s))
    out = []
    for r, ws, p in zip(rows, split, place):
        gone = {j for s in range(len(ws) - length + 1) if first[tuple(ws[s:s + length])] < (p, s) for j in range(s, s + length)}
        out.append((r[0], len(ws), len(gone), " ".join(w for j, w in enumerate(ws) if j not in gone)))
    return sorted(out, key=str)


def got(df, length):
    return sorted(map(tuple, remove_repeats(df, length).collect()), key=str)


def test_odd_rows(spark):
    rows = odd_rows()
    assert got(clashing(frame(spark, rows)), 20) == brute(rows, 20)


def test_many_overlaps(spark):
    rng = random.Random(5)
    parts = [" ".join(rng.choice("abc") for _ in range(rng.randint(3, 30))) for _ in range(6)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 6))), None, None, None) for i in range(60)]
    for length in (2, 5, 20):
        assert got(frame(spark, rows), length) == brute(rows, length)


def test_a_passage_that_all_share(spark):
    rows = [(i, f"u{i} " + " ".join(f"w{j}" for j in range(25)) + f" v{i}", None, None, None) for i in range(300)]
    assert got(frame(spark, rows, parts=7), 20) == brute(rows, 20)


def test_no_rows(spark):
    assert got(frame(spark, []), 20) == []
