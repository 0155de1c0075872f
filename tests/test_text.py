import hashlib

from pyspark.sql import functions as F

from tidemark.functions.labels import escape_label, label_text, number_text, select_labels
from tidemark.functions.status import kpi_band, log_classes
from tidemark.functions.text import compose_text, content_hash, is_blank_text, preprocess_text
from tidemark.functions.times import epoch_of_ntz, parse_duration

POSTS = [("t", "c"), ("t", None), ("t", ""), (None, "c"), ("", ""), (None, None),
         ("ü", "x" * 10_000), ("  a ", " b\n"), ("q\"", "emoji 🚀\nline")]


def _posts(spark):
    return spark.createDataFrame(POSTS, "title string, content string")


def test_hash_is_sha256_of_both_parts(spark):
    got = _posts(spark).select("title", "content", content_hash(F.col("title"), F.col("content"))
                               .alias("h")).collect()
    for r in got:
        text = f"{r.title or ''}\n{r.content or ''}"
        assert r.h == hashlib.sha256(text.encode()).hexdigest()
        assert len(r.h) == 64


def test_title_only_differs_from_content_only(spark):
    df = spark.createDataFrame([("x", ""), ("", "x")], "title string, content string")
    got = df.select(content_hash(F.col("title"), F.col("content")).alias("h")).distinct()
    assert got.count() == 2


def test_compose(spark):
    got = [r[0] for r in _posts(spark).select(compose_text(F.col("title"), F.col("content")))
           .collect()]
    want = [f"{t or ''}. {c}".strip() if c else (t or "") for t, c in POSTS]
    assert got == want


def test_preprocess_strips_like_python_and_cuts(spark):
    blanks = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    texts = [None, "", "  hi  ", blanks + "x" + blanks, "a" * 500, " " + "b " * 300,
             "🚀" * 401, "\x1c\x1fx\x85"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.p for r in df.select("i", preprocess_text(F.col("t"), 400).alias("p")).sort("i").collect()]
    assert got == [(t or "").strip()[:400] for t in texts]


def test_blank_flag(spark):
    df = spark.createDataFrame([(None,), (" \n",), ("x",)], "t string")
    assert [r[0] for r in df.select(is_blank_text(F.col("t"))).collect()] == [True, True, False]


def test_durations(spark):
    df = spark.createDataFrame([("30s",), ("5m",), ("2h",), ("24h",), ("0m",), ("x",), (None,)],
                               "d string")
    got = [r[0] for r in df.select(parse_duration(F.col("d"))).collect()]
    assert got == [30, 300, 7200, 86400, 0, None, None]


def test_epoch_before_and_after_1970(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:59:58.5' AS ts UNION ALL "
                   "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.9'")
    assert sorted(r[0] for r in df.select(epoch_of_ntz("ts")).collect()) == [-2, 1704067207]


def test_label_selectors(spark):
    df = spark.sql("SELECT map('job', 'a-b', 'x', '1') AS labels")

    def hit(**kw):
        return df.filter(select_labels(F.col("labels"), **kw)).count() == 1

    assert hit(equal={"job": "a-b"}) and not hit(equal={"job": "a"})
    assert hit(match={"job": "a-.*"}) and not hit(match={"job": "a"})
    assert hit(equal={"missing": ""}) and not hit(equal={"missing": "1"})


def test_label_text_is_sorted_and_escaped(spark):
    df = spark.sql("""SELECT map('b', '2', 'a', '1') AS m, map() AS e""")
    r = df.select(label_text(F.col("m")).alias("t"),
                  label_text(F.col("e").cast("map<string,string>")).alias("e")).first()
    assert r.t == '{a="1",b="2"}' and r.e == ""
    raw = spark.createDataFrame([('q"\\\n',)], "v string")
    assert raw.select(escape_label(F.col("v"))).first()[0] == 'q\\"\\\\\\n'


def test_numbers_as_exposition_text(spark):
    inf = float("inf")
    cases = {65.0: "65.0", 0.5: "0.5", 0.0: "0.0", 999999.0: "999999.0", 1234567.0: "1.234567e+06",
             1000000.0: "1e+06", 12345678.5: "1.23456785e+07", 0.0005: "0.0005",
             0.00012: "0.00012", 0.00001: "1e-05", inf: "+Inf", -inf: "-Inf",
             float("nan"): "NaN", -3.5: "-3.5"}
    df = spark.createDataFrame([(v, t) for v, t in cases.items()], "v double, want string")
    for r in df.select("v", "want", number_text(F.col("v")).alias("got")).collect():
        assert r.got == r.want, r


def test_bands_and_classes(spark):
    df = spark.createDataFrame([("posts_per_hour", 60.0, "good"), ("posts_per_hour", 50.0, "warning"),
                                ("posts_per_hour", 19.0, "critical"), ("cpu_percent", 80.0, "warning"),
                                ("cpu_percent", 81.0, "critical"), ("other", 1.0, None)],
                               "k string, v double, want string")
    assert all(r.b == r.want for r in
               df.select("want", kpi_band(F.col("k"), F.col("v")).alias("b")).collect())
    line = spark.createDataFrame([("ERROR 404 timeout",)], "l string")
    assert line.select(log_classes(F.col("l"))).first()[0] == ["critical", "performance",
                                                               "suspicious_4xx"]
