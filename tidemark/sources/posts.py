"""Posts: reading, restricting, normalising, and the flat CSV sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType
from pyspark.errors import AnalysisException

from tidemark.operators.ordered import top_n
from tidemark.schemas import POST, SAMPLE_POSTS, SCORED_POST
from tidemark.session import values_frame

#: Communities read when none are configured, and posts taken from each (fixed values).
DEFAULT_COMMUNITIES = "CryptoCurrency,Bitcoin,ethereum"
FETCH_LIMIT = 100


def community_list(text: str = DEFAULT_COMMUNITIES) -> list[str]:
    """Split at commas; blanks belong to the names."""
    return text.split(",")


def sample_posts(spark: SparkSession) -> DataFrame:
    return values_frame(spark, POST, SAMPLE_POSTS)


def read_posts(spark: SparkSession, path: str | list[str] | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Posts in the fixed schema; two sample posts when no input is configured."""
    if not path:
        return sample_posts(spark)
    return spark.read.schema(POST).format(fmt).load(path)


def by_community(posts: DataFrame, communities: list[str]) -> DataFrame:
    return posts.filter(F.col("subreddit").isin(communities))


def hottest(posts: DataFrame, rank: list[Column] | None = None, limit: int = FETCH_LIMIT) -> DataFrame:
    """At most ``limit`` posts per community, best ranked first."""
    order = rank or [F.desc("score"), F.col("post_id")]
    return top_n(posts, ["subreddit"], order, ["post_id"], limit)


def normalize_posts(posts: DataFrame, community: Column | None = None) -> DataFrame:
    """Empty body for a missing one, whole seconds, and the community as requested."""
    return (posts
            .withColumn("content", F.coalesce(F.col("content"), F.lit("")))
            .withColumn("created_utc", F.col("created_utc").cast("bigint"))
            .withColumn("subreddit", community if community is not None else F.col("subreddit")))


def parse_lines(lines: DataFrame, value: str, schema: StructType) -> DataFrame:
    """JSON lines to rows; a bad line keeps its text in ``_corrupt_record``."""
    wide = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    others = [c for c in lines.columns if c != value]
    return lines.select(*others, F.from_json(value, wide, options).alias("__r")) \
        .select(*others, "__r.*")


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad rows of :func:`parse_lines`."""
    bad = F.col("_corrupt_record").isNotNull()
    return parsed.filter(~bad).drop("_corrupt_record"), parsed.filter(bad)


def read_sources(spark: SparkSession, sources: dict[str, str],
                 fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Each configured source on its own: rows of those that open, and errors per source.

    A source that cannot be opened is counted and skipped; the others go on. A
    file inside a source that cannot be read is skipped too, and counted by the
    rows it failed to give: the errors have the number of a source's files
    without any row (an empty file is one of them).
    """
    reader = spark.read.schema(POST).option("ignoreCorruptFiles", "true")
    good, failed, counts = None, [], []
    for name, path in sources.items():
        try:
            raw = reader.format(fmt).load(path)
            rows = normalize_posts(raw, F.lit(name))
            counts.append(_unread_files(spark, path, raw).select(
                F.lit(name).alias("source"), F.lit("file_failed").alias("error_type"), "errors"))
        except AnalysisException:
            failed.append((name, "fetch_failed", 1))
            continue
        good = rows if good is None else good.unionByName(rows)
    schema = "source STRING, error_type STRING, errors BIGINT"
    errors = values_frame(spark, schema, failed) if failed else spark.createDataFrame([], schema)
    for unread in counts:
        errors = errors.unionByName(unread.filter("errors > 0"))
    return good if good is not None else spark.createDataFrame([], POST), errors


def _unread_files(spark: SparkSession, path: str, raw: DataFrame) -> DataFrame:
    """How many of the files below ``path`` gave no row; reads no content for it."""
    def uri(column):
        return F.regexp_replace(column, "^([A-Za-z0-9+.-]+):/+", "$1:/").alias("file")

    there = spark.read.format("binaryFile").load(path).filter("length > 0").select(uri("path"))
    read = raw.select(uri("_metadata.file_path")).distinct()
    return there.join(read, "file", "left_anti").agg(F.count(F.lit(1)).alias("errors"))


def write_csv(df: DataFrame, path: str) -> None:
    """Flat CSV with a header, replacing the run before; a failure ends the job.

    A folder of part files: one file would need one task to write everything,
    and one to read it, as quoted newlines keep a file from being split.
    """
    (df.write.mode("overwrite").option("maxRecordsPerFile", 500_000).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv(spark: SparkSession, path: str, schema: StructType = SCORED_POST) -> DataFrame:
    """The CSV read back; bodies may hold newlines and quotes.

    Nothing between two commas is null and a pair of quotes is ''; the reader
    tells them apart only if its null text is something else than ''.
    """
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("nullValue", "\x00").option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).csv(path))
