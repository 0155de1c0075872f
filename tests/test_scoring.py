import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators.scoring import (
    NEUTRAL,
    BatchModelScorer,
    LexiconScorer,
    argmax_of_map,
    fit_trained_scorer,
    score,
)
from tidemark.session import values_frame

# The model loaders below live here, where the workers cannot import them from.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEUTRAL_ROW = tuple(NEUTRAL.values())


def _texts(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def _scores(df):
    return [tuple(r.s) for r in df.select("i", F.col("sentiment").alias("s")).sort("i").collect()]


@pytest.fixture
def words(spark):
    return values_frame(spark, "token string, polarity int",
                        [("good", 1), ("great", 1), ("bad", -1), ("poor", -1)])


@pytest.mark.parametrize("inline", [100, 0])
def test_lexicon(spark, words, inline):
    df = _texts(spark, "Good, GREAT and bad.", "bad poor", "nothing here", "", None, "good bad")
    got = _scores(score(df, "t", LexiconScorer(words, inline_rows=inline)))
    assert got[0] == ("positive", 0.5, 0.5, 0.25, 0.25)
    assert got[1] == ("negative", 0.666667, 0.0, 0.666667, 0.333333)
    assert got[2] == ("neutral", 1.0, 0.0, 0.0, 1.0)
    assert got[3] == got[4] == NEUTRAL_ROW
    assert got[5][0] == "positive"  # the first class wins a tie


@pytest.mark.parametrize("inline", [100, 0])
def test_lexicon_counts_a_token_once(spark, inline):
    """Listed twice, with opposite polarities, or without one."""
    words = values_frame(spark, "token string, polarity int", [
        ("good", 1), ("good", 2), ("bad", -3), ("odd", 1), ("odd", -1), ("void", None)])
    df = _texts(spark, "good bad odd void", "odd void", "x " * 3000 + "good")
    got = _scores(score(df, "t", LexiconScorer(words, inline_rows=inline)))
    assert got == [("positive", 0.333333, 0.333333, 0.333333, 0.333333), ("neutral", 1.0, 0.0, 0.0, 1.0),
                   ("positive", 0.5, 0.5, 0.0, 0.5)]


def test_single_texts_tokens_are_not_shuffled(spark, words, monkeypatch):
    """Many blocks, words in all of them, a text in many rows; only a block's distinct tokens meet the lexicon."""
    from tidemark.operators import scoring

    monkeypatch.setattr(scoring, "BLOCK_BYTES", 500)
    texts = [f"good w{chr(97 + i % 26)} bad " + "poor " * (i % 5) + "the " * 20 + "x" * (i % 40) for i in range(150)]
    df = _texts(spark, *texts, *["great the same"] * 300, "", None)
    joined = score(df, "t", LexiconScorer(words, inline_rows=0))
    assert _scores(joined) == _scores(score(df, "t", LexiconScorer(words)))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    # Tokens go out with their block alone, and no row is copied to meet a salt.
    assert "hashpartitioning(token" in plan or "BroadcastHashJoin [token" in plan
    assert "FlatMapCoGroupsInArrow" in plan and "sequence(" not in plan and "__salt" not in plan


def test_trained_scorer_without_a_class(spark):
    labelled = spark.createDataFrame([("good fine", "positive"), ("bad sad", "negative")] * 4, "text string, label string")
    scorer = fit_trained_scorer(labelled, features=64)
    got = _scores(score(_texts(spark, "good fine", ""), "t", scorer))
    assert got[0][0] == "positive" and got[0][4] == 0.0 and got[1] == NEUTRAL_ROW


def test_no_scorer_is_neutral(spark):
    assert set(_scores(score(_texts(spark, "a", "", None), "t", None))) == {NEUTRAL_ROW}


def test_argmax(spark):
    df = spark.sql("SELECT map('POSITIVE', 0.2D, 'negative', 0.7D) m UNION ALL "
                   "SELECT map('neutral', 0.4D, 'positive', 0.4D)")
    got = sorted(tuple(r[0]) for r in df.select(argmax_of_map(F.col("m"))).collect())
    assert got == [("negative", 0.7, 0.2, 0.7, 0.0), ("positive", 0.4, 0.4, 0.0, 0.4)]


def _length_model():
    def model(texts):
        return [{"Positive": 0.1, "Negative": 0.2, "Neutral": len(t) / 1000} for t in texts]
    return model


def test_model_sees_whole_and_nonblank_texts_only(spark):
    df = _texts(spark, "", "x" * 5000, None, "  ")
    got = _scores(score(df, "t", BatchModelScorer(_length_model)))
    assert got[1] == ("neutral", 5.0, 0.1, 0.2, 5.0)
    assert got[0] == got[2] == got[3] == NEUTRAL_ROW


def _picky_model():
    def model(texts):
        if any("boom" in t for t in texts):
            raise ValueError("no")
        return [{"positive": 0.9, "negative": 0.1} for _ in texts]
    return model


def test_failed_list_is_retried_one_by_one(spark):
    df = _texts(spark, "fine", "boom", "also fine", "")
    done = score(df, "t", BatchModelScorer(_picky_model, batch_size=8))
    got = _scores(done)
    assert got[0] == got[2] == ("positive", 0.9, 0.9, 0.1, 0.0)
    assert got[1] == ("neutral", 0.34, 0.33, 0.33, 0.34)
    assert got[3] == NEUTRAL_ROW
    assert [r[0] for r in done.sort("i").select("sentiment_error").collect()] == [
        False, True, False, False]


def _missing_model():
    raise OSError("no weights")


def test_model_that_does_not_load(spark):
    done = score(_texts(spark, "a", ""), "t", BatchModelScorer(_missing_model))
    assert set(_scores(done)) == {NEUTRAL_ROW}


def test_trained(spark):
    rows = [("good great good", "positive"), ("bad poor bad", "negative"), ("the of a", "neutral")]
    df = spark.createDataFrame(rows * 10, "text string, label string")
    scorer = fit_trained_scorer(df, features=64)
    got = _scores(score(_texts(spark, "great good", "poor bad", ""), "t", scorer))
    assert [g[0] for g in got] == ["positive", "negative", "neutral"]
    assert got[2] == NEUTRAL_ROW and abs(sum(got[0][2:]) - 1) < 1e-9


def test_trained_by_hand(spark):
    """Add-one smoothing, tokens unknown to the model, a hot token, and repeated texts."""
    import math

    rows = [("good good the", "positive"), ("the fine", "positive"), ("bad the", "negative"), ("the", "neutral"), ("skip", None)]
    scorer = fit_trained_scorer(spark.createDataFrame(rows, "text string, label string"))
    counts = {"positive": {"good": 2, "the": 2, "fine": 1}, "negative": {"bad": 1, "the": 1}, "neutral": {"the": 1}}
    docs = {"positive": 2, "negative": 1, "neutral": 1}

    def by_hand(text):
        logs = {}
        for c, own in counts.items():
            n = sum(own.values())
            logs[c] = math.log((docs[c] + 1) / 7) + sum(
                math.log((own.get(w, 0) + 1) / (n + 4)) for w in text.lower().split() if w in ("good", "the", "fine", "bad"))
        whole = sum(math.exp(x) for x in logs.values())
        return [math.exp(logs[c]) / whole for c in ("positive", "negative", "neutral")]

    texts = ["good the", "Bad bad unknown", "the " * 50, "only unknown words", "good the"]
    for text, got in zip(texts, _scores(score(_texts(spark, *texts), "t", scorer))):
        assert got[2:] == pytest.approx(by_hand(text), abs=1e-6)


def test_trained_query_reads_whole_texts(spark, scratch):
    """The label depends on words after character 400 alone."""
    from tidemark.plans.post_queries import score_trained

    said = ["good great", "bad poor", "of a"]
    opening = "Title\n" + "same opening words " * 40
    spark.createDataFrame([(i, opening + said[i % 3] + " tail", "en", "a", 800) for i in range(30)],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 == 1)) for i in range(30)],
                          "doc_id bigint, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    got = {r.arrival_seq: r.label for r in score_trained(spark, scratch).collect()}
    assert got == {i: ("positive", "negative", "neutral")[i % 3] for i in range(30)}
