"""Operator 13: the trie of conversation prefixes, by ternary search trees per range shard.

A conversation is the sequence of its turns; a turn is a digest of role and text
(128 bits of SHA-256) and its text's number of words. Every distinct sequence of
first turns is a node of the trie, from the root, which has none.

Sequences are dealt to shards by ranges of (key, conv_id), where the key joins
short pieces of a sequence's first ``KEY_TURNS`` digests. Neighbouring sequences
so meet in one shard, and any number of equal ones is cut between shards by
their ids. A shard numbers its digests in sorted order and inserts its distinct
sequences into a ternary search tree, the median first, then the medians of both
halves, and so on, which keeps the comparisons of each turn logarithmic in the
number of siblings. One traversal with a stack of its own, not by recursion,
then adds up members, childless nodes and savings from the bottom.

A node can only have members in other shards if its key is a prefix of the
shard's first or last key. All other nodes are finished where they are. Those
boundary nodes, a path or two per shard, are merged by node: smallest member,
number of members, whether any shard knows a child. The first shard that has a
node then counts it, as a child, as a childless node and with its saving, and no
other does, so that each shard adds up its own paths once more and the sums over
shards are right; this takes the same three steps however deep the trie is.

A task holds the digests of one shard, ``SHARD_TURNS`` turns or one longer
conversation (16 bytes a turn): a conversation is not cut, so its turns have to
fit one task, texts aside.

Rows: null roles and texts are empty; turns are ordered by number, null first,
then by digest; rows that repeat are turns that repeat; rows without a conv_id
belong to no conversation and are ignored; a conversation without turns ends at
the root. Very long texts are digested where they are read. Other columns are
ignored. An empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

KEY_TURNS, PIECE = 64, 6
DIGEST = 16
SHARD_TURNS = 50_000
#: Ids of members that one row carries to the digest of a boundary node.
ENDS = 512

WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(DIGEST)


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, seq: the digests and word counts of each conversation's turns, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length keeps apart what role and text share out differently.
    digest = F.unhex(F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST))
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").cast("bigint").alias("turn"),
                    digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    turns = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint"), turn.alias("t"))
    seq = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t.digest.alias("digest"), t.words.alias("words")))
    return turns.groupBy("conv_id").agg(seq.alias("seq"))


def share_prefixes(seqs: DataFrame, every: int, count: Column) -> DataFrame:
    """Each conversation's first ``count`` turns replaced by those of the conversation at the last multiple of ``every``."""
    seqs = seqs.withColumn("source", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", count)
    heads = seqs.filter("conv_id = source").select("source", F.col("seq").alias("head"))
    head = F.coalesce(F.slice("head", 1, F.col("h")), F.slice("seq", 1, 0))
    return seqs.join(heads, "source", "left").select(
        "conv_id", F.concat(head, F.expr("slice(seq, h + 1, greatest(size(seq) - h, 0))")).alias("seq"))


class Tree:
    """A ternary search tree whose nodes are the nodes of a trie; node 0 is the root."""

    def __init__(self):
        self.code, self.low, self.equal, self.high = [-1], [-1], [-1], [-1]
        self.parent, self.depth = [-1], [0]
        self.ends: list[list[int]] = [[]]

    def _new(self, code: int, parent: int) -> int:
        for column, value in ((self.code, code), (self.low, -1), (self.equal, -1), (self.high, -1), (self.parent, parent),
                              (self.depth, self.depth[parent] + 1), (self.ends, [])):
            column.append(value)
        return len(self.code) - 1

    def insert(self, codes: list[int], members: list[int]) -> None:
        code, low, equal, high, node = self.code, self.low, self.equal, self.high, 0
        for c in codes:
            side, at = equal, node
            while (t := side[at]) >= 0 and code[t] != c:
                side, at = (low if c < code[t] else high), t
            if t < 0:
                t = side[at] = self._new(c, node)
            node = t
        self.ends[node] += members

    def insert_all(self, sorted_sequences: list[tuple[list[int], list[int]]]) -> None:
        """Distinct sequences in ascending order, with their members: medians first."""
        ranges = [(0, len(sorted_sequences))]
        while ranges:
            a, b = ranges.pop()
            if a < b:
                middle = (a + b) // 2
                self.insert(*sorted_sequences[middle])
                ranges += [(middle + 1, b), (a, middle)]

    def order(self) -> list[int]:
        """All nodes, parents of the trie before their children."""
        out, stack = [0], [self.equal[0]]
        while stack:
            if (t := stack.pop()) >= 0:
                out.append(t)
                stack += [self.low[t], self.high[t], self.equal[t]]
        return out


_SHARD = pa.schema([
    ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("shard", pa.int32()), ("piece", pa.int32()),
    ("boundary", pa.bool_()), ("below_boundary", pa.bool_()), ("words", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("has_child", pa.bool_()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.list_(pa.int64())), ("ends_sha256", pa.string())])
_SHARD_DDL = ("node binary, parent binary, depth bigint, shard int, piece int, boundary boolean, below_boundary boolean, "
              "words bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, has_child boolean, n_children bigint, "
              "n_leaves bigint, saved_tokens bigint, ends array<bigint>, ends_sha256 string")


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def _rows(keys: list[str], ids: list[int], blobs: list[bytes], words: list[list[int]], shard: int) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard, from its sequences in ascending order of (key, id)."""
    distinct = sorted({b[i:i + DIGEST] for b in blobs for i in range(0, len(b), DIGEST)})
    number = {d: i for i, d in enumerate(distinct)}
    count = {number[b[i * DIGEST:(i + 1) * DIGEST]]: w for b, ws in zip(blobs, words) for i, w in enumerate(ws)}
    members: dict[bytes, list[int]] = {}
    for blob, conv_id in zip(blobs, ids):
        members.setdefault(blob, []).append(conv_id)
    tree = Tree()
    tree.insert_all([([number[b[i:i + DIGEST]] for i in range(0, len(b), DIGEST)], members[b]) for b in sorted(members)])

    order = tree.order()
    size = len(order)
    name, edges = [ROOT] * size, [(True, True)] * size
    first, last, step = keys[0], keys[-1], 2 * PIECE
    for v in order[1:]:
        up, digest, depth = tree.parent[v], distinct[tree.code[v]], tree.depth[v]
        name[v] = hashlib.blake2b(name[up] + digest, digest_size=DIGEST).digest()
        edges[v] = edges[up]
        if depth <= KEY_TURNS and (edges[up][0] or edges[up][1]):
            at, piece = (depth - 1) * step, digest[:PIECE].hex().upper()
            edges[v] = (edges[up][0] and first[at:at + step] == piece, edges[up][1] and last[at:at + step] == piece)

    n_convs, conv_id = [len(e) for e in tree.ends], [min(e, default=None) for e in tree.ends]
    has_child, n_children, n_leaves, saved = [False] * size, [0] * size, [0] * size, [0] * size
    boundary = [a or b for a, b in edges]
    for v in reversed(order):
        if not boundary[v]:
            n_leaves[v] += not has_child[v]
            saved[v] += (n_convs[v] - 1) * count[tree.code[v]] if v else 0
        if v:
            up = tree.parent[v]
            has_child[up] = True
            n_convs[up] += n_convs[v]
            conv_id[up] = conv_id[v] if conv_id[up] is None else min(conv_id[up], conv_id[v])
            if not boundary[v]:  # boundary nodes are counted when they have been merged
                n_children[up] += 1
                n_leaves[up] += n_leaves[v]
                saved[up] += saved[v]

    for a in range(0, size, 5000):
        out = []
        for v in order[a:a + 5000]:
            up, ends = tree.parent[v], tree.ends[v]
            row = {"node": name[v], "parent": name[up] if v else None, "depth": tree.depth[v], "shard": shard,
                   "boundary": boundary[v], "below_boundary": v > 0 and boundary[up]}
            out.append(row | {
                "piece": 0, "words": count[tree.code[v]] if v else 0, "conv_id": conv_id[v],
                "parent_conv_id": conv_id[up] if v else None, "n_convs": n_convs[v], "has_child": has_child[v],
                "n_children": n_children[v], "n_leaves": n_leaves[v], "saved_tokens": saved[v],
                "ends": ends[:ENDS] if boundary[v] else None, "ends_sha256": None if boundary[v] else _digest(ends)})
            if boundary[v]:
                out += [row | {"piece": i // ENDS, "ends": ends[i:i + ENDS]} for i in range(ENDS, len(ends), ENDS)]
        yield pa.RecordBatch.from_pylist(out, schema=_SHARD)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, ids, blobs, words = [], [], [], []
    for batch in batches:
        for held, name in ((keys, "key"), (ids, "conv_id"), (blobs, "blob"), (words, "words")):
            held += batch[name].to_pylist()
    if ids:
        yield from _rows(keys, ids, blobs, words, TaskContext.get().partitionId())


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over each shard's own boundary paths; the rows of a shard arrive together, the deepest first."""
    shard, below = None, {}
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["shard"] != shard:
                shard, below = r["shard"], {}
            more = below.pop(r["node"], (0, 0, 0))
            sums = r["n_children"] + more[0], r["n_leaves"] + more[1], r["saved_tokens"] + more[2]
            out.append((r["node"], *sums))
            if r["parent"] is not None:
                have = below.get(r["parent"], (0, 0, 0))
                below[r["parent"]] = have[0] + r["as_child"], have[1] + sums[1], have[2] + sums[2]
        names = ["node", "n_children", "n_leaves", "saved_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*out), [pa.binary(), pa.int64(), pa.int64(), pa.int64()])] if out else
            [pa.array([], t) for t in (pa.binary(), pa.int64(), pa.int64(), pa.int64())], names=names)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids, which arrive in order, a piece at a time."""
    def row() -> pa.RecordBatch:
        return pa.record_batch({"node": pa.array([node], pa.binary()), "ends_sha256": pa.array([digest.hexdigest()])})

    node, digest, some = None, None, False
    for batch in batches:
        for own, ids in zip(batch["node"].to_pylist(), batch["ends"].to_pylist()):
            if own != node:
                if node is not None:
                    yield row()
                node, digest, some = own, hashlib.sha256(), False
            if ids:
                digest.update(("," * some + ",".join(map(str, ids))).encode())
                some = True
    if node is not None:
        yield row()


def trie(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``seqs`` (conv_id, seq), a row each.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    def joined(turns: str, size: int) -> Column:
        return F.array_join(F.transform(turns, lambda t: F.hex(F.substring(t.digest, 1, size))), "")

    seqs = written(seqs.select(F.when(F.size("seq") > KEY_TURNS, F.slice("seq", 1, KEY_TURNS)).otherwise(F.col("seq")).alias("head"),
                               "conv_id", "seq")
                       .select(joined("head", PIECE).alias("key"), "conv_id", F.unhex(joined("seq", DIGEST)).alias("blob"),
                               F.transform("seq", lambda t: t.words).alias("words")), "sequences")
    turns = seqs.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    nodes = written(seqs.repartitionByRange(max(1, -(-turns // shard_turns)), "key", "conv_id")
                        .sortWithinPartitions("key", "conv_id").mapInArrow(_shard, _SHARD_DDL), "nodes")
    paths = nodes.filter("boundary")
    heads = paths.filter("piece = 0")

    # The boundary nodes, merged; the first shard that has one counts it.
    merged = written(heads.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("has_child").alias("has_child"),
        F.min("shard").alias("owner"), F.first("depth").alias("depth"), F.first("parent").alias("parent")), "merged")
    found = merged.select("node", "owner", F.col("n_convs").alias("all"), F.col("has_child").alias("any_child"))
    owns = F.col("shard") == F.col("owner")
    counted = heads.join(found, "node").select(
        "shard", "depth", "node", "parent", owns.cast("bigint").alias("as_child"), "n_children",
        (F.col("n_leaves") + (owns & ~F.col("any_child")).cast("bigint")).alias("n_leaves"),
        (F.col("saved_tokens") + owns.cast("bigint") * (F.col("all") - 1) * F.col("words")).alias("saved_tokens"))
    sums = (counted.repartition("shard").sortWithinPartitions("shard", F.desc("depth"))
                   .mapInArrow(_settled, "node binary, n_children bigint, n_leaves bigint, saved_tokens bigint")
                   .groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]))
    ends = (paths.select("node", "shard", "piece", "ends").repartition("node").sortWithinPartitions("node", "shard", "piece")
                 .mapInArrow(_end_digests, "node binary, ends_sha256 string"))
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    borders = merged.join(sums, "node").join(ends, "node").join(above, "parent", "left").select(*columns)

    # A finished child of a boundary node looks its parent up in its own shard, so that the root is no hot key.
    inner = nodes.filter("NOT boundary")
    known = heads.select("node", "shard").join(merged.select("node", "conv_id"), "node") \
        .select(F.col("node").alias("parent"), "shard", F.col("conv_id").alias("parent_conv_id"))
    below = inner.filter("below_boundary").drop("parent_conv_id").join(known, ["parent", "shard"])
    return borders.unionByName(below.select(*columns)).unionByName(inner.filter("NOT below_boundary").select(*columns))
