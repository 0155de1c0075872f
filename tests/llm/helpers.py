"""Small corpora with every odd case, and frames made of them."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(n: int, seed: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioubcdfgh") for _ in range(rng.randint(1, 6))) + str(rng.randrange(vocabulary) % 7)
                    for _ in range(n))


def changed(text: str, every: int, start: int = 7) -> str:
    out = text.split(" ")
    for i in range(start, len(out), every):
        out[i] = f"new{i}"
    return " ".join(out)


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, only punctuation, repeats of rows and ids, accents, one long text."""
    base = words(120, 1)
    return [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, changed(base, 60), "en", "b", 1),
        (4, None, "en", "a", None), (5, "", None, None, 0), (6, " \n\t ", "en", "a", 3), (7, "?! ...", "de", "b", 6),
        (None, base, "en", "a", 1), (None, None, None, None, None),
        (8, words(90, 2), "de", "b", 1), (8, words(90, 2), "de", "b", 1), (8, words(70, 3), "fr", "b", 1),
        (9, "Über  Äpfel \x85und\x1cÖl. " * 3, "de", "c", 1), (10, "x", "en", "a", 1),
        (11, words(6000, 4), "en", "a", 1), (12, (words(12, 5) + "\n") * 9, "en", "a", 1),
    ]


def frame(spark: SparkSession, rows: list[tuple], schema: str = SCHEMA, parts: int = 3) -> DataFrame:
    return spark.createDataFrame(rows, schema).repartition(parts)


def clashing(docs: DataFrame) -> DataFrame:
    """The same rows with more columns, named like those that operators use."""
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("mine").alias(n) for n in
                              ("row", "h", "at", "did", "th", "id", "n", "n_words", "spans", "items", "u", "given", "host",
                               "key", "same", "kept", "score", "weight", "probability", "shares", "shard", "band")])
