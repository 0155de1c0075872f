import random
import re
from collections import Counter

import numpy as np
from helpers import clashing, frame, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.repetition import FIGURES, clean, measure
from tidemark.llm.suffixes import FMIndex, common_prefixes, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least=10):
    text = text or ""
    ws = WORD.findall(text)
    n = len(ws)
    longest = [0] * n
    for a in range(n):
        for b in range(a + 1, n):
            k = 0
            while b + k < n and ws[a + k] == ws[b + k]:
                k += 1
            longest[a], longest[b] = max(longest[a], k), max(longest[b], k)
    covered = {j for i, k in enumerate(longest) if k >= least for j in range(i, i + k)}
    three = Counter(zip(ws, ws[1:], ws[2:]))
    twice = {j for i in range(n - 2) if three[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice),
            len(covered), max(longest, default=0))


def test_figures(spark):
    rng = random.Random(2)
    rows = [r for r in odd_rows() if len(r[1] or "") < 10000]
    rows += [(100 + i, "\n".join(" ".join(rng.choice(["a#", "bé", "<c>"]) for _ in range(rng.randint(0, 9)))
                                 for _ in range(rng.randint(0, 12))), None, None, None) for i in range(60)]
    out = measure(clashing(frame(spark, rows))).select("row.doc_id", *FIGURES).collect()
    assert sorted(map(tuple, out), key=str) == sorted([(r[0], *brute(r[1])) for r in rows], key=str)


def test_verdicts(spark):
    base = words(300, 8)
    rows = [(1, base, *"ab", 1), (2, base + " " + " ".join(base.split()[:120]), *"ab", 1), (3, "a b c " * 100, *"ab", 1),
            (4, words(49, 9), *"ab", 1), (5, words(50, 9), *"ab", 1)]
    out = {r.row["doc_id"]: (r.base_failed, r.kept) for r in measure(frame(spark, rows)).collect()}
    assert out == {1: (False, True), 2: (True, False), 3: (True, False), 4: (True, False), 5: (False, True)}
    longer = " ".join(base.split()[:70])
    one = [(1, words(230, 7) + " " + longer + " " + words(20, 6) + " " + longer, *"ab", 1)]
    row = measure(frame(spark, one)).first()
    assert not row.base_failed and row.longest_repeat == 70 and not row.kept
    kept = clean(clashing(frame(spark, rows)))
    assert kept.columns == clashing(frame(spark, rows)).columns and {r.doc_id for r in kept.collect()} == {1, 5}
    assert measure(frame(spark, [])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(s):
    s = np.array(s, np.int64)
    sa, levels = suffix_array(s)
    want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert sa.tolist() == want
    lcp = common_prefixes(sa, levels)
    for a, b, k in zip(want, want[1:], lcp[1:]):
        x, y = s[a:].tolist(), s[b:].tolist()
        assert x[:k] == y[:k] and (x[k:k + 1] != y[k:k + 1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=4))
def test_backward_search(s, pattern):
    s, k = np.array(s, np.int64), len(pattern)
    index = FMIndex(s, 3, step=4)
    low, high = index.search(np.array([[0] * (4 - k) + pattern]), np.array([k]))
    places = sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist())
    assert places == [i for i in range(len(s) - k + 1) if s[i:i + k].tolist() == pattern]
