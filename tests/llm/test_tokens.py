import zlib

import numpy as np
import pytest
from helpers import clashing, frame, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import tokens
from tidemark.llm.queries import END_ID, TOKENIZER
from tidemark.session import scratch_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(TOKENIZER, END_ID)


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]


pieces = st.sampled_from(["the", "The", "'s", "'LL", "it's", " ", "\n", "\x85", " ", "\x1c", "É", "é", "H̱",
                          "Σ", "ς", "İ", "K", "½", "9", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "<", "|",
                          "...", "!?", "'", "***", "字", "　", "🙂"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(pieces | st.text(max_size=3), max_size=12).map("".join), min_size=1, max_size=4))
def test_word_by_word_is_the_tokenizer_itself(tokenizer, encoder, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert got == [plain(tokenizer, t) for t in texts]


def test_marks_behind_letters(tokenizer, encoder):
    marks = [chr(i) for i in range(33, 127) if not chr(i).isalnum()]
    texts = [f"{w}{a}{b}" for w in ("ab", "É", "xß", "×a", "é÷", "K") for a in marks for b in ("", ".", "'", "s", "1")]
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert encoder.by_word and got == [plain(tokenizer, t) for t in texts]


def test_known_words_are_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_BYTES", 5000)
    own = tokens.Encoder(TOKENIZER, END_ID)
    for i in range(30):
        text = " ".join(f"w{i}x{j}." for j in range(20))
        assert np.frombuffer(own.encode([text.encode()])[0], own.kind).tolist() == plain(tokenizer, text)
        assert len(own.known) < 100


def test_new_words_reach_the_tokenizer_some_at_a_time(tokenizer):
    """Its results take far more memory than ids; all new words of a task at once were too much for an executor."""
    class Watched:
        def __init__(self, inner):
            self.inner, self.most = inner, 0

        def encode_batch_fast(self, texts, **how):
            self.most = max(self.most, len(texts))
            return self.inner.encode_batch_fast(texts, **how)

    own = tokens.Encoder(TOKENIZER, END_ID)
    own.tokenizer, own.bare = Watched(own.tokenizer), Watched(own.bare)
    letters = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(20_000)]
    text = " ".join(w for i, x in enumerate(letters) for w in (x, f"{i}{x}"))
    assert np.frombuffer(own.encode([text.encode()])[0], own.kind).tolist() == plain(tokenizer, text)
    assert 0 < own.tokenizer.most <= 64 and 0 < own.bare.most <= 64


def test_pieces_hold_every_text():
    import pyarrow as pa

    from tidemark.llm.common import pieces

    texts = ["ab", None, "", "é" * 9, "x", "y" * 3, None, "z" * 40, "w"]
    for limit in (1, 4, 7, 1000):
        found = list(pieces(pa.array(["cut off", *texts]).slice(1), limit))
        assert [t for piece in found for t in piece] == [(t or "").encode() for t in texts]
        assert all(len(piece) == 1 or sum(map(len, piece)) <= limit for piece in found)
    assert list(pieces(pa.array([], pa.string()))) == []


def test_another_tokenizer_encodes_whole_texts():
    """One that keeps case and white space, so that words alone would give other ids."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, texts = tokens.Encoder(path, END_ID), ["Ab  cD ", "", "x\ny"]
    assert not own.by_word
    assert [np.frombuffer(x, own.kind).tolist() for x in own.encode([t.encode() for t in texts])] == [
        plain(Tokenizer.from_file(path), t) for t in texts]


def test_round_trip_order_and_short_document_access(spark, tokenizer):
    rows = [(i, t, *r) for i, t, *r in odd_rows()]
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(clashing(frame(spark, rows)), path, TOKENIZER, END_ID, shard_bytes=4000, block_bytes=800)
    got = tokens.read_tokens(spark, path).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: -1 if x is None else x)
    start = 0
    for r in got:
        assert r.start == start
        start += len(r.ids)
    want = sorted((-1 if i is None else i, plain(tokenizer, t)) for i, t, *_ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids) for r in got) == want
    digests = {(r.doc_id, r.start): r for r in tokens.read_digests(spark, path).collect()}
    for r in got:
        d = digests[r.doc_id, r.start]
        assert (d.n_tokens, d.ids_crc32) == (len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
    assert {r.doc_id: r.ids for r in tokens.fetch(spark, path, [3, 10]).collect()} == {
        i: plain(tokenizer, t) for i, t, *_ in rows if i in (3, 10)}
    assert spark.read.parquet(f"{path}/blocks").select("shard").distinct().count() > 1


def test_another_dictionary_is_refused(spark):
    path, other = scratch_path(spark, "tokens"), scratch_path(spark, "tokens")
    docs = frame(spark, odd_rows())
    tokens.write_tokens(docs, path, TOKENIZER, END_ID)
    tokens.write_tokens(docs.filter("doc_id > 8"), other, TOKENIZER, END_ID)
    raw, _, width, _ = tokens._opened(spark, other)
    blocks = tokens._opened(spark, path)[3]
    with pytest.raises(Exception, match="another dictionary"):
        tokens._decoded(blocks, raw, "wrong", width, "doc_id bigint", lambda out: None).collect()


def test_no_rows(spark):
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(frame(spark, []), path, TOKENIZER, END_ID)
    assert tokens.read_digests(spark, path).collect() == []
