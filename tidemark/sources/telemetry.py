"""Metrics text, log lines, alert payloads, file manifests and the health sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import label_text, number_text
from tidemark.schemas import ALERT_PAYLOAD, LOG_RECORD

#: ``asctime - name - level - message`` (fixed pattern).
LOG_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})(?:,\d+)? - (.+?) - ([A-Z]+) - (?s)(.*)$"

#: One exposition line: name, optional label block, value, optional time (fixed pattern).
SAMPLE_PATTERN = (r'^([a-zA-Z_:][a-zA-Z0-9_:]*)(?:\{((?:[^"}]|"(?:[^"\\]|\\.)*")*)\})?'
                  r"\s+(\S+)(?:\s+(-?\d+))?\s*$")
LABEL_PATTERN = r'([a-zA-Z_][a-zA-Z0-9_]*)="((?:[^"\\]|\\.)*)"'


# Metrics text ---------------------------------------------------------------------------------

def exposition_lines(samples: DataFrame, metric: str = "metric", labels: str = "labels",
                     value: str = "value", out: str = "line", t: str | None = None) -> DataFrame:
    """Samples as text lines ``name{k="v",...} value``, with the time in milliseconds if ``t`` is named."""
    time = [] if t is None else [F.lit(" "), (F.col(t).cast("bigint") * 1000).cast("string")]
    return samples.select(F.concat(F.col(metric), label_text(F.col(labels)), F.lit(" "),
                                   number_text(F.col(value)), *time).alias(out))


def histogram_samples(buckets: DataFrame, totals: DataFrame, metric: str,
                      by: list[str]) -> DataFrame:
    """``_bucket`` rows with an ``le`` label, ``_sum`` and ``_count`` rows, as samples."""
    def labelled(*extra: Column) -> Column:
        pairs = [x for k in by for x in (F.lit(k), F.col(k))]
        return F.create_map(*pairs, *extra) if pairs or extra else F.map_from_arrays(
            F.array().cast("array<string>"), F.array().cast("array<string>"))

    rows = buckets.select(
        F.lit(f"{metric}_bucket").alias("metric"),
        labelled(F.lit("le"), number_text(F.col("le"))).alias("labels"),
        F.col("cumulative").cast("double").alias("value"))
    for field in ("sum", "count"):
        rows = rows.unionByName(totals.select(
            F.lit(f"{metric}_{field}").alias("metric"), labelled().alias("labels"),
            F.col(field).cast("double").alias("value")))
    return rows


def parse_exposition(lines: DataFrame, line: str = "line", at: Column | None = None) -> DataFrame:
    """Text lines back to ``metric, labels, value``; comments and other lines are dropped.

    With ``at``, the time of the scrape in seconds, samples get ``t``: the time
    on their line, in whole seconds, or else that of the scrape.
    """
    text = F.col(line)
    block = F.coalesce(F.regexp_extract(text, SAMPLE_PATTERN, 2), F.lit(""))
    raw = F.regexp_extract(text, SAMPLE_PATTERN, 3)
    number = (F.when(raw == "+Inf", float("inf")).when(raw == "-Inf", float("-inf"))
              .when(raw == "NaN", float("nan")).otherwise(raw.try_cast("double")))
    names = F.regexp_extract_all(block, F.lit(LABEL_PATTERN), F.lit(1))
    values = F.transform(F.regexp_extract_all(block, F.lit(LABEL_PATTERN), F.lit(2)), _unescape)
    others = [c for c in lines.columns if c != line]
    stamp = F.regexp_extract(text, SAMPLE_PATTERN, 4).try_cast("bigint")
    time = [] if at is None else [F.coalesce(F.floor(stamp / 1000).cast("bigint"), at).alias("t")]
    return (lines.filter(text.rlike(SAMPLE_PATTERN))
            .select(*others, F.regexp_extract(text, SAMPLE_PATTERN, 1).alias("metric"),
                    F.map_from_arrays(names, values).alias("labels"), number.alias("value"), *time))


def metric_types(lines: DataFrame, line: str = "line") -> DataFrame:
    """``metric, type`` of the ``# TYPE`` lines, one row per metric; the first type by name if they differ."""
    pattern = r"^#\s+TYPE\s+(\S+)\s+(counter|gauge|histogram|summary|untyped)\s*$"
    text = F.col(line)
    return (lines.filter(text.rlike(pattern))
            .groupBy(F.regexp_extract(text, pattern, 1).alias("metric"))
            .agg(F.min(F.regexp_extract(text, pattern, 2)).alias("type")))


def with_types(samples: DataFrame, types: DataFrame, metric: str = "metric") -> DataFrame:
    """Samples with their metric's ``type``: that of its own line, or of the histogram or summary it is part of."""
    base = F.regexp_replace(metric, "_(bucket|sum|count)$", "")
    own = types.select(F.col("metric").alias(metric), F.col("type").alias("__own"))
    part = types.filter(F.col("type").isin("histogram", "summary")).select(
        F.col("metric").alias("__base"), F.col("type").alias("__part"))
    return (samples.withColumn("__base", base).join(own, metric, "left").join(part, "__base", "left")
            .withColumn("type", F.coalesce("__own", "__part", F.lit("untyped"))).drop("__base", "__own", "__part"))


def _unescape(value: Column) -> Column:
    # Escaped backslashes are cut out first; the pieces hold the other escapes only.
    pieces = F.transform(F.split(value, r"\\\\"), lambda p: F.replace(
        F.replace(p, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n")))
    return F.array_join(pieces, "\\")


def scrape_lines(files: DataFrame) -> DataFrame:
    """Lines of text files (batch or stream) with the file and its time in seconds, as ``at``."""
    return files.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                        F.unix_timestamp("_metadata.file_modification_time").alias("at"))


def read_exposition(spark: SparkSession, path: str) -> DataFrame:
    """Scrape files to samples with the file they came from and their time."""
    return parse_exposition(scrape_lines(spark.read.text(path)), at=F.col("at")).drop("at")


def stream_exposition(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream: every scrape file below ``path`` once, as it arrives."""
    files = spark.readStream.text(path)
    return parse_exposition(scrape_lines(files), at=F.col("at")).drop("at")


# Logs -----------------------------------------------------------------------------------------

def parse_log_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Text log lines to ``asctime, name, levelname, message``; a line that does not fit the
    format keeps its text as the message and has no level."""
    text = F.col(line)
    fits = text.rlike(LOG_PATTERN)

    def part(i: int) -> Column:
        return F.when(fits, F.regexp_extract(text, LOG_PATTERN, i))

    others = [c for c in lines.columns if c != line]
    return lines.select(*others, part(1).alias("asctime"), part(2).alias("name"),
                        part(3).alias("levelname"),
                        F.coalesce(part(4), text).alias("message"))


def read_text_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_log_lines(spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")))


def read_json_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_RECORD).json(path)


# Alert payloads -------------------------------------------------------------------------------

def explode_payloads(payloads: DataFrame, body: str = "body") -> DataFrame:
    """One row per alert in each JSON document, with the defaults for missing fields."""
    others = [c for c in payloads.columns if c != body]
    alerts = payloads.select(*others, F.from_json(body, ALERT_PAYLOAD).alias("__p")) \
        .select(*others, F.explode("__p.alerts").alias("__a"))

    def label(name: str, default: str) -> Column:
        return F.coalesce(F.col("__a.labels")[name], F.lit(default)).alias(name)

    def note(name: str) -> Column:
        return F.coalesce(F.col("__a.annotations")[name], F.lit("")).alias(name)

    return alerts.select(
        *others, label("alertname", "Unknown"), label("severity", "unknown"),
        label("service", "unknown"), label("instance", "unknown"), label("component", ""),
        note("description"), note("runbook_url"), note("value"),
        F.coalesce(F.col("__a.status"), F.lit("unknown")).alias("status"),
        F.col("__a.startsAt").alias("starts_at"), F.col("__a.endsAt").alias("ends_at"))


# Files ----------------------------------------------------------------------------------------

#: Files over this size have no checksum unless a caller says otherwise.
CHECKED_BYTES = 2**31 - 2**20


def file_manifest(spark: SparkSession, path: str, glob: str | None = None,
                  recursive: bool = True, checked_bytes: int | None = CHECKED_BYTES) -> DataFrame:
    """Path, size, time and MD5 of every file.

    Files are listed by Spark's binary file source, which does not open them for
    that, and a task streams them through the digest one by one. A file over
    ``checked_bytes`` is listed without being opened, its checksum null; with
    None there is no such limit.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    checksum = _streamed_md5(spark, "path")
    if checked_bytes is not None:
        checksum = F.when(F.col("length") <= checked_bytes, checksum)
    return reader.load(path).select("path", "length", "modificationTime", checksum.alias("checksum"))


def _streamed_md5(spark: SparkSession, path: str) -> Column:
    """MD5 of the files a column names, in any store that Spark reads.

    Spark itself only hands a file's content over as one value. So this is the
    expression ``new DigestUtils("MD5").digestAsHex(fs.open(path))`` of the
    libraries Spark comes with; a task holds a buffer of the stream, which is
    closed at its end. It counts as not deterministic, so that a plan never
    reads a file twice.
    """
    jvm = spark.sparkContext._jvm
    objects, expressions = jvm.org.apache.spark.sql.catalyst.expressions.objects, jvm.org.apache.spark.sql.classic.ExpressionUtils
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()

    def seq(*values):
        return jvm.PythonUtils.toSeq(list(values))

    def kind(name: str):
        return jvm.org.apache.spark.sql.types.ObjectType(loader.loadClass(name))

    def new(name: str, *args):
        return objects.NewInstance(loader.loadClass(name), seq(*args), seq(), True, kind(name), jvm.scala.Option.empty())

    def call(target, method: str, result: str, *args):
        return objects.Invoke(target, method, kind(result), seq(*args), seq(), True, True, False)

    def static(name: str, method: str, result, *args):
        return objects.StaticInvoke(loader.loadClass(name), result, method, seq(*args), seq(), True, True, True, jvm.scala.Option.empty())

    def text(column: Column):
        return call(expressions.expression(column._jc), "toString", "java.lang.String")

    util, fs = "org.apache.spark.deploy.SparkHadoopUtil", "org.apache.hadoop.fs"
    file = new(f"{fs}.Path", text(F.col(path)))
    conf = call(static(util, "get", kind(util)), "conf", "org.apache.hadoop.conf.Configuration")
    stream = call(call(file, "getFileSystem", f"{fs}.FileSystem", conf), "open", f"{fs}.FSDataInputStream", file)
    digest = call(new("org.apache.commons.codec.digest.DigestUtils", text(F.lit("MD5"))), "digestAsHex", "java.lang.String",
                  new("org.apache.commons.io.input.AutoCloseInputStream", stream))
    strings = jvm.org.apache.spark.sql.types.DataType.fromDDL("string")
    return Column(expressions.column(static("org.apache.spark.unsafe.types.UTF8String", "fromString", strings, digest)))


def write_status(status: DataFrame, path: str) -> None:
    """Health or run summary as JSON, replacing the one before."""
    status.write.mode("overwrite").json(path)
