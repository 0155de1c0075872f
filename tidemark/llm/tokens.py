"""Operator 4: token ids in shards of separately compressed documents.

Every document is its own zstandard frame, compressed with one dictionary that
was trained on serialized id arrays, so that a short document can be read alone
at nearly the size it would have in a large frame.

A token folder holds ``blocks`` and ``dictionary`` (both Parquet, the columns of
frames uncompressed, as they are compressed already). A row of ``blocks`` is a
run of consecutive documents of one shard: their ids, token counts, places in
the shard and frame ends (the offset index), and their frames one after the
other. A column-pruned read of the index does not touch the frames.
``dictionary`` has one row: the dictionary, its hash, the id width and the end
id. Every block carries the dictionary's hash; a reader refuses another one.

Spark commits the files, so that a lost executor leaves no half-written shard.

Shards are ranges of ids: Spark deals the texts to them by sampled bounds, and
each is sorted, encoded and compressed by one task in a single pass over its rows.

Rows: a null text counts as empty and holds the end id alone; null ids sort
first; equal ids are ordered by a hash of their texts, so that the files do
not depend on the input's order, and may share a shard or not. A very long text
is encoded and compressed by itself and is a block of its own. Other columns are
ignored. An empty table gives an empty folder of blocks.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hand_back, pieces, released

#: Documents that the dictionary is trained on, and the bytes of ids each gives at most.
SAMPLE_DOCS, SAMPLE_BYTES = 1_000, 1 << 15
DICTIONARY_BYTES = 64 << 10
#: Bytes of words and ids that a worker remembers; results do not depend on it.
KNOWN_BYTES = 64 << 20
#: Text bytes whose words are told apart together, some 15 times as many bytes of memory.
ENCODED_BYTES = 4 << 20
#: Runs of new words that are encoded together; the tokenizer's own results take far more room than their ids.
_RUNS = 64
#: Text bytes per shard and frame bytes per block (a longer document is its own block).
SHARD_BYTES, BLOCK_BYTES = 32 << 20, 1 << 20

BLOCKS = ("shard int, block int, dict_hash string, doc_ids array<bigint>, n_tokens array<bigint>, "
          "starts array<bigint>, ends array<bigint>, frames binary")


#: New words are encoded so many to a text, with a special token of the vocabulary between them.
_RUN, _BETWEEN = 256, "<|startoftext|>"
#: Marks that are pieces of their own behind letters: ASCII but for letters, digits, ``'`` and ``<``.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<")
#: Bytes of ASCII and Latin-1 letters (their first byte is C3), and of the small ones alone.
_SMALL = bytes([*range(97, 123), 0xC3, *range(0x9F, 0xB7), *range(0xB8, 0xC0)])
_LETTERS = _SMALL + bytes([*range(65, 91), *range(0x80, 0x97), *range(0x98, 0x9F)])
#: Texts with a control string, or an accent that might join its letter, are not lower-cased before.
_AS_IT_IS = r"<\||[\x{300}-\x{37f}]"
#: What a dictionary entry costs beside its bytes.
_ENTRY = 200
#: Texts on which the encoder is held against the tokenizer before it is used.
_PROBES = ["Ab  cD\nef, gh.\tIJ", " été...; \u00c9TÉ$$$ x!y", "a'll b's'c. d\u0301e, 12ab3.4%", "", "\u00bd ß\u1e9e (\u0130i)",
           "one <|x two|> <a>b</a> ***"]


class Encoder:
    """Texts to id arrays, in which every new word is encoded once.

    The tokenizer drops white space and no token spans it, so the ids of a text
    are those of its ASCII-space-separated words in a row, and marks behind
    letters are encoded apart from them. It lower-cases, so words are
    lower-cased first, unless an accent might then join its letter or a control
    string might arise. A tokenizer for which this does not hold on some texts
    made for the purpose encodes whole texts instead. ``width`` is 2 where the
    vocabulary fits 16 bits, else 4.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.end = np.array([end_id], self.kind).tobytes()
        self.between = self.tokenizer.token_to_id(_BETWEEN)
        # Small letters are one piece that no normaliser changes, and a piece's last token says that it is.
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        self.by_word = True
        probes = [x.encode() for x in _PROBES]
        try:
            self.by_word = self.encode(probes) == self._whole(probes)
        except ValueError:
            self.by_word = False
        self.known.clear()

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() + self.end for x in found]

    def _enter(self, run: list[bytes], ids: np.ndarray, begins: list[int], ends: list[int]) -> None:
        if len(begins) != len(run) or len(ends) != len(run):
            raise ValueError("the tokenizer does not keep words apart")
        raw, width = ids.tobytes(), self.width
        self.known.update(zip(run, [raw[a * width:b * width] for a, b in zip(begins, ends)]))

    @staticmethod
    def _encoded(tokenizer, runs: list[list[bytes]], between: str) -> Iterator[tuple]:
        for i in range(0, len(runs), _RUNS):
            some = runs[i:i + _RUNS]
            yield from zip(some, tokenizer.encode_batch_fast([between.join([w.decode() for w in run]) for run in some],
                                                             add_special_tokens=False))

    def _learn(self, words: list[bytes]) -> None:
        """Enter ``words``, none of them known, with their ids."""
        known, marked = self.known, []
        new = set()
        for w in words:
            letters = w.rstrip(_MARKS)
            if 0 < len(letters) < len(w) and not letters.translate(None, _LETTERS):
                marked.append((w, letters, w[len(letters):]))
                new.update(marked[-1][1:])
            else:
                new.add(w)
        new.difference_update(known)
        letters, others, apart = [], [], []
        for w in new:
            (apart if self.between is None or b"<|" in w else letters if not w.translate(None, _SMALL) else others).append(w)
        for w, x in zip(apart, self.tokenizer.encode_batch_fast([w.decode() for w in apart], add_special_tokens=False)):
            known[w] = np.array(x.ids, self.kind).tobytes()
        runs = [others[i:i + _RUN] for i in range(0, len(others), _RUN)]
        for run, x in self._encoded(self.tokenizer, runs, _BETWEEN):
            ids = np.array(x.ids, self.kind)
            between = np.flatnonzero(ids == self.between)
            self._enter(run, ids, [0, *(between + 1).tolist()], [*between.tolist(), len(ids)])
        runs = [letters[i:i + _RUN] for i in range(0, len(letters), _RUN)]
        for run, x in self._encoded(self.bare, runs, " "):
            ids = np.array(x.ids, self.kind)
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            self._enter(run, ids, [0, *ends[:-1]], ends)
        known.update((w, known[a] + known[b]) for w, a, b in marked)
        self.held += sum(map(len, new)) * 2 + _ENTRY * (len(new) + len(marked))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as bytes, with the end id behind them.

        Words are told apart and numbered by Arrow, so that Python sees every
        distinct word of ``texts`` once.
        """
        if not self.by_word:
            return self._whole(texts)
        if self.held > KNOWN_BYTES:
            self.known.clear()
            self.held = 0
        strings = pa.array(texts, pa.binary()).cast(pa.string())
        lowered = pc.if_else(pc.match_substring_regex(strings, _AS_IT_IS), strings, pc.ascii_lower(strings))
        words = pc.ascii_split_whitespace(lowered)
        coded = words.flatten().dictionary_encode()
        own = coded.dictionary.cast(pa.binary()).to_pylist()
        self.known[b""] = b""  # before the first and behind the last white space
        self._learn([w for w in own if w not in self.known])
        ids = pa.array(map(self.known.__getitem__, own), pa.binary(), size=len(own)).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, ids.offset * 4) if len(ids) else np.zeros(1, np.int32)
        data = ids.buffers()[2] if len(ids) else None
        places = ends[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        raw = data.to_pybytes() if data is not None else b""
        return [raw[a:b] + self.end for a, b in zip(places, places[1:])]


@lru_cache(maxsize=1)
def _encoder(path: str, end_id: int) -> Encoder:
    """A Python worker keeps its encoder, and the words it knows, from task to task."""
    return Encoder(path, end_id)


def _sample(docs: DataFrame, path: str, end_id: int) -> list[bytes]:
    """Id arrays of ``SAMPLE_DOCS`` documents, those whose hashed ids are smallest."""
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, end_id)
        for batch in batches:
            for texts in pieces(batch["text"]):
                ids = [x[:SAMPLE_BYTES] for x in encoder.encode(texts)]
                yield pa.record_batch({"ids": pa.array(ids, pa.binary())})

    # The ids are chosen first, so that only texts of the sample are moved.
    by = F.xxhash64("doc_id")
    last = docs.select(by.alias("h")).orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if last is None:
        return []
    first = docs.filter(by <= last).limit(SAMPLE_DOCS)
    return [bytes(r.ids) for r in first.mapInArrow(released(encoded), "ids binary").collect()]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A shared dictionary; empty where the samples are too few to train one."""
    pieces = [s[i:i + 2048] for s in samples for i in range(0, len(s), 2048)]
    size = min(size, sum(map(len, pieces)) // 8)
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, level: int = 3,
                 shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write the token folder ``path``, ids ascending.

    One pass measures the texts; Spark samples the ids and deals the texts to
    shards, each of which a task encodes and streams into blocks.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    raw = train_dictionary(_sample(docs, tokenizer, end_id))
    dict_hash = hashlib.sha256(raw).hexdigest()
    width = Encoder(tokenizer, end_id).width
    spark.createDataFrame([(dict_hash, raw, width, end_id)],
                          "dict_hash string, dictionary binary, width int, end_id bigint") \
        .write.parquet(f"{path}/dictionary")

    arrow = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("dict_hash", pa.string()),
                       *((n, pa.list_(pa.int64())) for n in ("doc_ids", "n_tokens", "starts", "ends")),
                       ("frames", pa.binary())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(tokenizer, end_id), TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(raw))
        block, start, held, size = 0, 0, [], 0

        def row() -> pa.RecordBatch:
            counts = np.array([n for _, n, _ in held], np.int64)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "dict_hash": dict_hash,
                "doc_ids": [d for d, _, _ in held], "n_tokens": counts.tolist(),
                "starts": (start + np.cumsum(counts) - counts).tolist(),
                "ends": np.cumsum([len(f) for _, _, f in held]).tolist(),
                "frames": b"".join(f for _, _, f in held)}], schema=arrow)

        for batch in batches:
            ids = iter(batch["doc_id"].to_pylist())
            for texts in pieces(batch["text"], ENCODED_BYTES):
                for a in encoder.encode(texts):
                    d = next(ids)
                    f = packer.compress(a)
                    if held and size + len(f) > block_bytes:
                        yield row()
                        start += sum(n for _, n, _ in held)
                        block, held, size = block + 1, [], 0
                    held.append((d, len(a) // encoder.width, f))
                    size += len(f)
            # What Arrow and the tokenizer keep for later use would add up beside the executor's heap.
            hand_back()
        if held:
            yield row()

    order = [F.asc_nulls_first("doc_id"), "tie"]
    (docs.withColumn("tie", F.xxhash64("text")).repartitionByRange(shards, *order).sortWithinPartitions(*order)
         .select("doc_id", "text").mapInArrow(released(blocks), BLOCKS)
         .write.option("compression", "none").parquet(f"{path}/blocks"))


def _opened(spark: SparkSession, path: str):
    head = spark.read.parquet(f"{path}/dictionary").first()
    raw = bytes(head.dictionary)
    if hashlib.sha256(raw).hexdigest() != head.dict_hash:
        raise ValueError("the dictionary does not have the hash it was stored under")
    return raw, head.dict_hash, head.width, spark.read.schema(BLOCKS).parquet(f"{path}/blocks")


def _decoded(blocks: DataFrame, raw: bytes, dict_hash: str, width: int, schema: str, shape) -> DataFrame:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            for r in batch.to_pylist():
                if r["dict_hash"] != dict_hash:
                    raise ValueError("a block was compressed with another dictionary")
                wanted = r.get("wanted") or range(len(r["ends"]))
                begins = [0, *r["ends"]]
                out = [(r["shard"], r["doc_ids"][i], r["starts"][i],
                        np.frombuffer(opener.decompress(r["frames"][begins[i]:begins[i + 1]]),
                                      f"<u{width}").astype("<u4")) for i in wanted]
                yield shape(out)

    return blocks.mapInArrow(released(decode), schema)


def _placed(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add the tokens of earlier shards to ``start``; the table of shards has one row for each."""
    totals = blocks.groupBy("shard").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"),
                                                            lambda a, x: a + x)).alias("tokens"))
    before = totals.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("before"))
    return rows.join(before, "shard").withColumn("start", F.col("start") + F.col("before")).drop("shard", "before")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a token folder: doc_id, ids (array<bigint>), start (tokens before it)."""
    raw, dict_hash, width, blocks = _opened(spark, path)

    def shape(out):
        return pa.RecordBatch.from_pylist(
            [{"shard": s, "doc_id": d, "start": t, "ids": ids.tolist()} for s, d, t, ids in out],
            schema=pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()),
                              ("ids", pa.list_(pa.int64()))]))

    return _placed(_decoded(blocks, raw, dict_hash, width,
                            "shard int, doc_id bigint, start bigint, ids array<bigint>", shape), blocks)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Start, token count and checksum of every document, from its stored frame."""
    raw, dict_hash, width, blocks = _opened(spark, path)

    def shape(out):
        return pa.record_batch({
            "shard": pa.array([x[0] for x in out], pa.int32()), "doc_id": pa.array([x[1] for x in out], pa.int64()),
            "start": pa.array([x[2] for x in out], pa.int64()), "n_tokens": pa.array([len(x[3]) for x in out], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x[3]) for x in out], pa.int64())})

    rows = _decoded(blocks, raw, dict_hash, width,
                    "shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", shape)
    return _placed(rows, blocks).select("doc_id", "start", "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Only the named documents: the index picks blocks, and only their own frames are opened."""
    raw, dict_hash, width, blocks = _opened(spark, path)
    ids = F.array(*[F.lit(int(d)).cast("bigint") for d in doc_ids])
    place = F.filter(F.sequence(F.lit(0), F.size("doc_ids") - 1),
                     lambda i: F.array_contains(ids, F.get("doc_ids", i)))
    hit = blocks.filter(F.arrays_overlap("doc_ids", ids)).withColumn("wanted", place)

    def shape(out):
        return pa.RecordBatch.from_pylist([{"doc_id": d, "ids": x.tolist()} for _, d, _, x in out],
                                          schema=pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    return _decoded(hit, raw, dict_hash, width, "doc_id bigint, ids array<bigint>", shape)
