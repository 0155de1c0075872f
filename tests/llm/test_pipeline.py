"""The stages one by one on a small corpus; ``tests/test_queries.py`` runs the registered queries."""

import re
from collections import Counter

import pyarrow as pa
import pytest
from helpers import changed, clashing, frame, words
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_near_duplicates import brute as classes_by_brute_force
from test_repetition import brute as figures_by_brute_force

import corpus_pipeline
from tidemark.llm import repetition
from tidemark.llm.common import place, ranged
from tidemark.session import scratch_path

NAMES = ["quality_rules", "near_dedup", "decontaminate", "mix", "write_tokens"]


def corpus():
    rows = [(i, words(60 + i, i), "en", "ab"[i % 2], 1) for i in range(30)]
    rows += [(50, rows[0][1], "en", "a", 1), (51, changed(rows[29][1], 90), "en", "a", 1), (52, "x y z " * 40, "en", "a", 1),
             (53, words(60, 70) + " " + words(30, 71) + " " + words(60, 72), "en", "b", 1), (54, None, None, None, None),
             (55, "short", "en", "b", 1)]
    return rows


def verdict(text):
    n, _, _, _, twice, covered, longest = figures_by_brute_force(text)
    return not (n < 50 or 100 * twice > 50 * n or covered > repetition.MAX_COVERED * n
                or (longest > repetition.FREE_LONGEST and longest > repetition.MAX_LONGEST * n))


@pytest.mark.parametrize("stage", ["quality_rules", "decontaminate", "mix"])
def test_texts_reach_a_task_once(spark, stage, capsys):
    """A batch that held every text twice took twice the memory, in the executor and in its Python worker."""
    folder = scratch_path(spark, "tables")
    spark.createDataFrame([(1, words(30, 71))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    path = scratch_path(spark, "docs")
    frame(spark, corpus()).write.parquet(path)
    out = dict(corpus_pipeline.STAGES)[stage](spark, spark.read.parquet(path), folder)
    capsys.readouterr()
    out.explain(True)
    tasks = re.findall(r"MapInArrow \w+\(([^)]*)\)", capsys.readouterr().out)
    assert tasks and all("row#" in x and "text#" not in x for x in tasks)


def test_text_column_in_any_case(spark):
    docs = frame(spark, corpus())
    as_it_is, other = (Counter(map(tuple, repetition.clean(d).collect())) for d in (docs, docs.withColumnRenamed("text", "TEXT")))
    assert as_it_is == other
    with pytest.raises(AnalysisException):
        place(docs.drop("text"), "text")
    with pytest.raises(AnalysisException):
        place(docs.select("*", F.lit("").alias("Text")), "text")


def test_pieces_hold_every_text_once():
    texts = [None, "", "abc", "x" * 40, None, "é" * 3, ""]
    for limit in (1, 5, 100):
        found = list(ranged(pa.array(["cut off", *texts])[1:], limit))
        assert [x for _, _, part in found for x in part] == [(x or "").encode() for x in texts]
        assert [i for low, high, _ in found for i in range(low, high)] == list(range(len(texts)))
        assert all(len(part) == 1 or sum(map(len, part)) <= limit for _, _, part in found)
    assert [part for *_, part in ranged(pa.nulls(2))] == [[b"", b""]]
    assert not list(ranged(pa.array([], pa.string())))


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    folder = scratch_path(spark, "tables")
    spark.createDataFrame([(1, words(30, 71))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = corpus()
    docs = clashing(frame(spark, rows))
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality_rules"](spark, docs, folder)
    assert kept.columns == docs.columns
    rows = [r for r in rows if verdict(r[1])]
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows}
    single = stages["near_dedup"](spark, kept, folder)
    rows = [r for r in rows if r[0] in {i for i, c in classes_by_brute_force(rows) if i == c}]
    assert {r.doc_id for r in single.collect()} == {r[0] for r in rows} and 51 not in {r[0] for r in rows}
    clean = stages["decontaminate"](spark, single, folder)
    rows = [r for r in rows if r[0] != 53]
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows}
    mixed = stages["mix"](spark, clean, folder)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {r[0] for r in rows}
    out = stages["write_tokens"](spark, clean, folder)
    assert {r.doc_id for r in out.collect()} == {r[0] for r in rows}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
