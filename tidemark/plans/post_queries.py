"""Queries on posts: sources, text, de-duplication, scoring, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import compose_text, content_hash, is_blank_text, preprocess_text
from tidemark.operators import aggregates as agg
from tidemark.operators import dedup
from tidemark.operators.scoring import (
    BatchModelScorer,
    LexiconScorer,
    argmax_of_map,
    fit_trained_scorer,
    neutral_struct,
    score,
)
from tidemark.plans import fixtures as fx
from tidemark.plans.batch import RunConfig, run, run_reporting
from tidemark.plans.batch import scored_posts as as_scored
from tidemark.plans.registry import query
from tidemark.plans.run_metrics import DURATION, LAST_RUN, fetched_samples, run_samples
from tidemark.schemas import POST, SCORED_COLUMNS, SEEN
from tidemark.session import scratch_path, values_frame
from tidemark.sources import posts as src
from tidemark.sources.store import SeenStore
from tidemark.sources.telemetry import exposition_lines

_POST = ", ".join(POST.names)


def _tagged(spark, sf):
    return dedup.duplicate_flag(fx.posts_hashed(spark, sf), fx.seen_store(spark, sf))


def _scorer(spark):
    return LexiconScorer(fx.lexicon(spark))


def written(spark, sf):
    """The table a run writes: unique posts, scored."""
    unique = dedup.dedup_against(dedup.dedup_first_wins(fx.posts_hashed(spark, sf)),
                                 fx.seen_store(spark, sf))
    return as_scored(unique, _scorer(spark), "run-1")


def _all_scored(spark, sf):
    """Every post with its label and score, duplicates too."""
    p = fx.posts_hashed(spark, sf).withColumn(
        "text", compose_text(F.col("title"), F.col("content")))
    done = score(p, "text", _scorer(spark))
    return done.select("arrival_seq", "post_id", "title", "content", "created_utc", "subreddit",
                       "content_hash", F.col("sentiment.label").alias("sentiment_label"),
                       F.col("sentiment.confidence").alias("sentiment_score"))


# Sources and sinks ----------------------------------------------------------------------------

@query("posts_scan", f"SELECT {_POST} FROM posts")
def posts_scan(spark, sf):
    return fx.posts(spark, sf).select(*POST.names)


@query("posts_by_community", "SELECT post_id, subreddit FROM posts "
                             "WHERE subreddit IN ('src1', 'src7', ' src2')")
def posts_by_community(spark, sf):
    wanted = src.community_list("src1,src7, src2")
    return src.by_community(fx.posts(spark, sf), wanted).select("post_id", "subreddit")


@query("top_n_per_community", """
SELECT subreddit, post_id, score, rank FROM (
  SELECT subreddit, post_id, score, row_number() OVER (
    PARTITION BY subreddit ORDER BY score DESC, post_id) AS rank FROM posts) t
WHERE rank <= 10""")
def top_n_per_community(spark, sf):
    best = src.hottest(fx.posts(spark, sf).select("subreddit", "post_id", "score"), limit=10)
    return best.withColumn("rank", F.col("rank").cast("bigint"))


@query("posts_normalized", """
SELECT post_id, coalesce(CASE WHEN num_comments = 7 THEN NULL ELSE content END, '') AS content,
       created_utc, concat('c/', subreddit) AS subreddit FROM posts""")
def posts_normalized(spark, sf):
    raw = fx.posts(spark, sf)
    raw = raw.withColumn("content", F.when(F.col("num_comments") != 7, F.col("content"))) \
             .withColumn("created_utc", F.col("created_utc") + F.lit(0.75))
    return src.normalize_posts(raw, F.concat(F.lit("c/"), "subreddit")).select(
        "post_id", "content", "created_utc", "subreddit")


@query("bad_record_quarantine", """
SELECT event_type AS source, count(*) FILTER (WHERE event_id % 17 <> 0) AS good,
       count(*) FILTER (WHERE event_id % 17 = 0) AS bad FROM events GROUP BY 1""")
def bad_record_quarantine(spark, sf):
    from pyspark.sql.types import StructType

    broken = F.when(F.col("event_id") % 17 == 0, F.substring("props", 1, 4)) \
        .otherwise(F.col("props"))
    lines = fx.events(spark, sf).select(F.col("event_type").alias("source"), broken.alias("line"))
    parsed = src.parse_lines(lines, "line", StructType.fromDDL("k BIGINT"))
    bad = F.col("_corrupt_record").isNotNull()
    return parsed.groupBy("source").agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))


@query("csv_roundtrip", f"SELECT {', '.join(SCORED_COLUMNS)} FROM written")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    src.write_csv(written(spark, sf), path)
    return src.read_csv(spark, path)


@query("seen_store_upsert", """
SELECT post_id, content_hash, title, subreddit, created_utc, created_utc AS first_seen_utc
FROM tagged WHERE NOT is_duplicate AND post_id NOT IN (SELECT post_id FROM seen_store)""")
def seen_store_upsert(spark, sf):
    return dedup.insert_if_absent(fx.posts_hashed(spark, sf), fx.seen_store(spark, sf))


@query("seen_store_restart", """
SELECT post_id, content_hash, title, subreddit, created_utc, first_seen_utc FROM seen_store
UNION ALL
SELECT post_id, content_hash, title, subreddit, created_utc, created_utc FROM tagged
WHERE NOT is_duplicate AND post_id NOT IN (SELECT post_id FROM seen_store)""")
def seen_store_restart(spark, sf):
    """A store written by two runs, the second of them twice, then opened anew."""
    path = scratch_path(spark, "store")
    store = SeenStore(spark, path)
    store.commit(fx.seen_store(spark, sf), "run-0")
    for _ in range(2):
        fresh = dedup.insert_if_absent(fx.posts_hashed(spark, sf), store.read(excluding="run-1"))
        store.commit(fresh, "run-1")
    return SeenStore(spark, path).read().select(*SEEN.names)


# Text -----------------------------------------------------------------------------------------

@query("content_hash", "SELECT post_id, content_hash FROM posts_hashed")
def content_hash_query(spark, sf):
    return fx.posts(spark, sf).select(
        "post_id", content_hash(F.col("title"), F.col("content")).alias("content_hash"))


@query("compose_text", r"""
SELECT post_id, CASE WHEN content <> '' THEN regexp_replace(concat(title, '. ', content),
       '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g') ELSE title END AS text FROM posts""")
def compose_text_query(spark, sf):
    return fx.posts(spark, sf).select(
        "post_id", compose_text(F.col("title"), F.col("content")).alias("text"))


@query("preprocess_text", "SELECT arrival_seq, text FROM texts")
def preprocess_text_query(spark, sf):
    return fx.texts(spark, sf).select("arrival_seq", "text")


@query("empty_text_flag", """
SELECT doc_id, (doc_id % 9 = 0 OR doc_id % 10 = 0) AS is_empty FROM documents""")
def empty_text_flag(spark, sf):
    d = F.col("doc_id")
    text = F.when(d % 9 == 0, F.lit(" \n\t　")).when(d % 10 != 0, F.col("text"))
    return fx.table(spark, sf, "documents").select("doc_id", is_blank_text(text).alias("is_empty"))


# De-duplication -------------------------------------------------------------------------------

@query("dedup_first_wins", """
SELECT post_id, content_hash, arrival_seq FROM posts_hashed
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY arrival_seq) = 1""")
def dedup_first_wins(spark, sf):
    hashed = fx.posts_hashed(spark, sf).select("post_id", "content_hash", "arrival_seq")
    return dedup.dedup_first_wins(hashed)


@query("dedup_vs_store", """
SELECT post_id, content_hash FROM posts_hashed
WHERE content_hash NOT IN (SELECT content_hash FROM seen_store)""")
def dedup_vs_store(spark, sf):
    return dedup.dedup_against(fx.posts_hashed(spark, sf).select("post_id", "content_hash"),
                               fx.seen_store(spark, sf), repeated=True)


@query("dup_flag", "SELECT post_id, is_duplicate FROM tagged")
def dup_flag(spark, sf):
    return _tagged(spark, sf).select("post_id", "is_duplicate")


@query("dedup_strict", """
WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER (ORDER BY arrival_seq) AS n FROM posts_edited),
walk AS (
  SELECT 0::BIGINT AS n, []::VARCHAR[] AS ids, []::VARCHAR[] AS hashes, false AS emitted
  UNION ALL
  SELECT r.n,
    CASE WHEN NOT list_contains(w.hashes, r.content_hash) AND NOT list_contains(w.ids, r.post_id)
         THEN list_append(w.ids, r.post_id) ELSE w.ids END,
    CASE WHEN NOT list_contains(w.hashes, r.content_hash) AND NOT list_contains(w.ids, r.post_id)
         THEN list_append(w.hashes, r.content_hash) ELSE w.hashes END,
    NOT list_contains(w.hashes, r.content_hash)
  FROM walk w JOIN numbered r ON r.n = w.n + 1)
SELECT m.arrival_seq, m.post_id, m.content_hash FROM walk w JOIN numbered m ON m.n = w.n
WHERE w.emitted""")
def dedup_strict(spark, sf):
    emitted, _ = dedup.dedup_strict(fx.posts_edited(spark, sf))
    return emitted.select("arrival_seq", "post_id", "content_hash")


@query("store_stats", """
SELECT count(*) AS total_posts, min(first_seen_utc) AS oldest_post,
       max(first_seen_utc) AS newest_post FROM seen_store""")
def store_stats(spark, sf):
    return dedup.store_stats(fx.seen_store(spark, sf))


@query("store_by_community",
       "SELECT subreddit, count(*) AS posts FROM seen_store GROUP BY 1 ORDER BY 2 DESC, 1")
def store_by_community(spark, sf):
    return dedup.store_by_community(fx.seen_store(spark, sf))


# Scoring --------------------------------------------------------------------------------------

_SCORES = "arrival_seq, label, positive, negative, neutral"


def _composed(spark, sf):
    """Texts as the run hands them to a scorer, which preprocesses them itself."""
    return fx.posts(spark, sf).select(
        "arrival_seq", compose_text(F.col("title"), F.col("content")).alias("text"))


def _score_columns(df):
    s = F.col("sentiment")
    return df.select("arrival_seq", s["label"].alias("label"), s["positive"].alias("positive"),
                     s["negative"].alias("negative"), s["neutral"].alias("neutral"))


@query("score_lexicon", f"SELECT {_SCORES} FROM scored")
def score_lexicon(spark, sf):
    return _score_columns(score(_composed(spark, sf), "text", _scorer(spark)))


@query("score_lexicon_joined", f"SELECT {_SCORES} FROM scored")
def score_lexicon_joined(spark, sf):
    """The form a lexicon too large for literals takes."""
    scorer = LexiconScorer(fx.lexicon(spark), inline_rows=0)
    return _score_columns(score(_composed(spark, sf), "text", scorer))


def _counting_model():
    """Stands in for a model: counts the test lexicon's words."""
    import regex

    word = regex.compile(r"\p{L}+")
    polarity = dict(fx.LEXICON)

    def model(texts):
        out = []
        for text in texts:
            found = [polarity.get(w, 0) for w in word.findall(text.lower())]
            pos, neg = found.count(1), found.count(-1)
            whole = pos + neg + 1.0
            out.append({"Positive": round(pos / whole, 6), "Negative": round(neg / whole, 6),
                        "Neutral": round(1 / whole, 6)})
        return out
    return model


@query("score_udf", f"SELECT {_SCORES}, false AS failed FROM scored")
def score_udf(spark, sf):
    done = score(_composed(spark, sf), "text", BatchModelScorer(_counting_model, batch_size=64))
    s = F.col("sentiment")
    return done.select("arrival_seq", s["label"].alias("label"), s["positive"].alias("positive"),
                       s["negative"].alias("negative"), s["neutral"].alias("neutral"),
                       F.col("sentiment_error").alias("failed"))


def _picky_model():
    """The same, failing on the whole list if a text's length is a multiple of 7."""
    model = _counting_model()

    def picky(texts):
        if any(len(t) % 7 == 0 for t in texts):
            raise ValueError("cannot score this text")
        return model(texts)
    return picky


@query("score_failures", """
SELECT arrival_seq, CASE WHEN failed THEN 'neutral' ELSE label END AS label,
       CASE WHEN failed THEN 0.33 ELSE positive END AS positive,
       CASE WHEN failed THEN 0.33 ELSE negative END AS negative,
       CASE WHEN failed THEN 0.34 ELSE neutral END AS neutral, failed
FROM scored JOIN (SELECT arrival_seq, text <> '' AND length(text) % 7 = 0 AS failed FROM whole_texts) t
  USING (arrival_seq)""")
def score_failures(spark, sf):
    """A model that fails on some texts: those alone get the fallback, the rest of their list is retried."""
    done = score(_composed(spark, sf), "text", BatchModelScorer(_picky_model, batch_size=16))
    s = F.col("sentiment")
    return done.select("arrival_seq", s["label"].alias("label"), s["positive"].alias("positive"),
                       s["negative"].alias("negative"), s["neutral"].alias("neutral"),
                       F.col("sentiment_error").alias("failed"))


@query("score_trained", r"""
WITH classed AS (
  SELECT t.arrival_seq, t.text, t.arrival_seq % 5 = 0 AS held_out,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' WHEN l.doc_id IS NOT NULL
              THEN 'neutral' END AS class
  FROM whole_texts t LEFT JOIN labels l ON l.doc_id = t.arrival_seq),
words AS (
  SELECT arrival_seq, token, count(*) AS n FROM (
    SELECT arrival_seq, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS token FROM classed) a
  WHERE token <> '' GROUP BY 1, 2),
classes AS (
  SELECT class, ln((count(*) + 1)::DOUBLE / (sum(count(*)) OVER () + count(*) OVER ())) AS prior
  FROM classed WHERE class IS NOT NULL AND NOT held_out GROUP BY class),
counted AS (
  SELECT token, class, sum(n) AS n FROM words JOIN classed USING (arrival_seq)
  WHERE class IS NOT NULL AND NOT held_out GROUP BY 1, 2),
totals AS (SELECT class, sum(n) AS total FROM counted GROUP BY 1),
model AS (
  SELECT token, t.class, CAST(round(ln((coalesce(c.n, 0) + 1)::DOUBLE / (total + size)::DOUBLE), 9) AS DECIMAL(20, 9)) AS logp
  FROM (SELECT DISTINCT token FROM counted) v CROSS JOIN totals t
  CROSS JOIN (SELECT count(DISTINCT token) AS size FROM counted) s LEFT JOIN counted c USING (token, class)),
sums AS (
  SELECT d.arrival_seq, d.held_out, c.class,
         round(c.prior, 9) + coalesce(CAST(sum(w.n * m.logp) AS DOUBLE), 0) AS logp
  FROM classed d CROSS JOIN classes c LEFT JOIN words w USING (arrival_seq)
  LEFT JOIN model m ON m.token = w.token AND m.class = c.class WHERE d.text <> ''
  GROUP BY d.arrival_seq, d.held_out, c.class, c.prior),
odds AS (
  SELECT *, exp(logp - max(logp) OVER (PARTITION BY arrival_seq)) AS p FROM sums)
SELECT arrival_seq, held_out, first(class ORDER BY p DESC,
         CASE class WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 ELSE 2 END) AS label,
       round(max(p) / sum(p), 6) AS confidence
FROM odds GROUP BY 1, 2
UNION ALL SELECT arrival_seq, held_out, 'neutral', 0.5 FROM classed WHERE text = ''""")
def score_trained(spark, sf):
    """Naive Bayes fitted on the labelled documents, but for every fifth, which is held out."""
    text = _composed(spark, sf).select(F.col("arrival_seq").alias("doc_id"), preprocess_text(F.col("text")).alias("text"))
    labelled = fx.table(spark, sf, "labels").filter("doc_id % 5 <> 0").withColumn(
        "label", F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
        .otherwise("neutral")).join(text, "doc_id")
    scorer = fit_trained_scorer(labelled, "text", "label")
    done = score(text.withColumnRenamed("doc_id", "arrival_seq"), "text", scorer)
    s = F.col("sentiment")
    return done.select("arrival_seq", (F.col("arrival_seq") % 5 == 0).alias("held_out"), s["label"].alias("label"),
                       F.round(s["confidence"], 6).alias("confidence"))


@query("argmax_label", """
SELECT event_id, CASE WHEN p >= n AND p >= u THEN 'positive' WHEN n >= u THEN 'negative'
       ELSE 'neutral' END AS label, greatest(p, n, u) AS confidence,
       p AS positive, n AS negative, u AS neutral
FROM (SELECT event_id, CAST(user_id % 4 AS DOUBLE) AS p, CAST(event_id % 5 AS DOUBLE) AS n,
             CASE WHEN event_id % 3 = 0 THEN 0.0::DOUBLE ELSE 2.0 END AS u FROM events) t""")
def argmax_label(spark, sf):
    """Scores as a map; one event in three has no neutral score."""
    two = F.create_map(F.lit("Positive"), (F.col("user_id") % 4).cast("double"),
                       F.lit("NEGATIVE"), (F.col("event_id") % 5).cast("double"))
    scores = F.when(F.col("event_id") % 3 == 0, two).otherwise(
        F.map_concat(two, F.create_map(F.lit("neutral"), F.lit(2.0))))
    s = F.col("s")
    return fx.events(spark, sf).select("event_id", argmax_of_map(scores).alias("s")).select(
        "event_id", s["label"].alias("label"), s["confidence"].alias("confidence"),
        s["positive"].alias("positive"), s["negative"].alias("negative"),
        s["neutral"].alias("neutral"))


@query("neutral_fallback", """
SELECT doc_id, 'neutral' AS label, 0.5::DOUBLE AS confidence, 0.33::DOUBLE AS positive,
       0.33::DOUBLE AS negative, 0.34::DOUBLE AS neutral FROM documents""")
def neutral_fallback(spark, sf):
    done = score(fx.table(spark, sf, "documents").select("doc_id", "text"), "text", None)
    return done.select("doc_id", "sentiment.*")


@query("batch_scored_posts", f"SELECT {', '.join(SCORED_COLUMNS)} FROM written")
def batch_scored_posts(spark, sf):
    return written(spark, sf)


@query("run_metrics", """
SELECT concat('reddit_posts_fetched_total{subreddit="', subreddit, '"} ',
              CAST(count(*)::DOUBLE AS VARCHAR)) AS line FROM posts GROUP BY subreddit
UNION ALL
SELECT concat('reddit_posts_deduplicated_total ', CAST(count(*)::DOUBLE AS VARCHAR)) FROM tagged
WHERE is_duplicate
UNION ALL
SELECT concat('reddit_posts_processed_total ', CAST(count(*)::DOUBLE AS VARCHAR)) FROM written
UNION ALL
SELECT concat('sentiment_distribution_total{label="', sentiment_label, '"} ',
              CAST(count(*)::DOUBLE AS VARCHAR)) FROM written GROUP BY sentiment_label
UNION ALL
SELECT 'pipeline_status 1.0'""")
def run_metrics(spark, sf):
    """A whole run into a fresh sink and store, and what it reports."""
    base = scratch_path(spark, "run")
    store = SeenStore(spark, f"{base}/store")
    store.commit(fx.seen_store(spark, sf), "earlier")
    posts = fx.posts(spark, sf)
    result = run(spark, RunConfig(sink=f"{base}/out", store=store, posts=posts, run_id="run-1",
                                  scorer=_scorer(spark)))
    timeless = ~F.col("metric").startswith(DURATION) & (F.col("metric") != LAST_RUN)
    samples = fetched_samples(posts).unionByName(run_samples(spark, result))
    return exposition_lines(samples.filter(timeless))


class _Refusing:
    """A scorer that lets nothing through."""

    def add(self, df, text, out):
        return df.withColumn(out, neutral_struct()).filter(F.col("arrival_seq") < 0)


@query("run_reasons", """
SELECT 'whole' AS run, CAST(NULL AS VARCHAR) AS reason, (SELECT count(*) FROM tagged) AS fetched,
       (SELECT count(*) FROM written) AS processed
UNION ALL SELECT 'again', 'no_unique_posts', (SELECT count(*) FROM posts), 0
UNION ALL SELECT 'nowhere', 'no_posts_fetched', 0, 0
UNION ALL SELECT 'refused', 'empty_dataframe', (SELECT count(*) FROM posts), 0
UNION ALL SELECT 'broken', 'execution_failed', 0, 0""")
def run_reasons(spark, sf):
    """Five runs over all posts, and why each ended."""
    base, posts = scratch_path(spark, "reasons"), fx.posts(spark, sf)
    store = SeenStore(spark, f"{base}/store")
    store.commit(fx.seen_store(spark, sf), "earlier")

    def go(name, into=store, **more):
        config = RunConfig(**({"sink": f"{base}/out", "store": into, "posts": posts, "run_id": name} | more))
        result = run_reporting(spark, config)
        return name, result.reason, result.fetched, result.processed

    rows = [go("whole"), go("again"), go("nowhere", communities=["no such place"]),
            go("refused", SeenStore(spark, f"{base}/other"), scorer=_Refusing()), go("broken", posts=None, source=f"{base}/missing")]
    return values_frame(spark, "run STRING, reason STRING, fetched BIGINT, processed BIGINT", rows)


# Reports --------------------------------------------------------------------------------------

@query("label_distribution", "SELECT sentiment_label, count(*) AS posts FROM written GROUP BY 1 "
                             "ORDER BY 2 DESC, 1")
def label_distribution(spark, sf):
    return agg.label_distribution(written(spark, sf))


@query("label_ratios", """
SELECT round(count(*) FILTER (WHERE sentiment_label = 'positive')::DOUBLE / count(*), 6)
         AS positive,
       round(count(*) FILTER (WHERE sentiment_label = 'negative')::DOUBLE / count(*), 6)
         AS negative,
       round(count(*) FILTER (WHERE sentiment_label = 'neutral')::DOUBLE / count(*), 6)
         AS neutral FROM scored_posts""")
def label_ratios(spark, sf):
    return agg.label_ratios(_all_scored(spark, sf))


@query("sentiment_over_time", """
SELECT created_utc - created_utc % 3600 AS slot, subreddit,
       count(*) FILTER (WHERE sentiment_label = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment_label = 'negative') AS negative,
       count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral
FROM scored_posts GROUP BY 1, 2""")
def sentiment_over_time(spark, sf):
    return agg.sentiment_over_time(_all_scored(spark, sf))


@query("fetched_by_community",
       "SELECT subreddit, count(*) AS posts FROM posts GROUP BY 1 ORDER BY 2 DESC, 1")
def fetched_by_community(spark, sf):
    return agg.count_by(fx.posts(spark, sf), ["subreddit"], "posts")


@query("run_summary", """
SELECT count(*) AS fetched, count(*) FILTER (WHERE NOT is_duplicate) AS "unique",
       count(*) FILTER (WHERE is_duplicate) AS duplicates,
       count(*) FILTER (WHERE NOT is_duplicate) AS processed,
       count(*) FILTER (WHERE NOT is_duplicate AND label = 'positive') AS positive,
       count(*) FILTER (WHERE NOT is_duplicate AND label = 'negative') AS negative,
       count(*) FILTER (WHERE NOT is_duplicate AND label = 'neutral') AS neutral,
       CAST(NULL AS VARCHAR) AS reason
FROM tagged JOIN scored ON tagged.arrival_seq = scored.arrival_seq""")
def run_summary(spark, sf):
    flagged = dedup.duplicate_flag(_all_scored(spark, sf), fx.seen_store(spark, sf))
    return agg.run_summary(flagged)


@query("duplicate_rate", """
SELECT created_utc - created_utc % 86400 AS slot, count(*) AS fetched,
       count(*) FILTER (WHERE is_duplicate) AS duplicates,
       round(count(*) FILTER (WHERE is_duplicate)::DOUBLE / count(*) * 100.0, 6)
         AS duplicate_percent FROM tagged GROUP BY 1""")
def duplicate_rate(spark, sf):
    return agg.duplicate_rate(_tagged(spark, sf))


@query("quality_counts", """
SELECT count(*) AS total_posts, count(*) FILTER (WHERE arrival_seq % 8 = 0) AS missing_sentiment,
       count(*) FILTER (WHERE sentiment_score < 0.5) AS low_confidence FROM scored_posts""")
def quality_counts(spark, sf):
    df = _all_scored(spark, sf).withColumn("sentiment_confidence", F.col("sentiment_score")) \
        .withColumn("sentiment_score", F.when(F.col("arrival_seq") % 8 != 0,
                                              F.col("sentiment_score")))
    return agg.quality_counts(df)


@query("daily_volume", """
SELECT created_utc - created_utc % 86400 AS day, count(*) AS posts_per_day,
       CAST(sum(length(content)) AS BIGINT) AS data_size FROM posts GROUP BY 1 ORDER BY 1""")
def daily_volume(spark, sf):
    return agg.daily_volume(fx.posts(spark, sf))


@query("recent_posts_count", """
SELECT count(*) AS recent FROM posts WHERE created_utc > 1704067200 + 60000 - 86400 / 4""")
def recent_posts_count(spark, sf):
    return agg.recent_count(fx.posts(spark, sf), "created_utc", fx.START + 60000, 21600)


@query("export_filtered", """
SELECT post_id, subreddit, title, sentiment_label, sentiment_score, created_utc FROM scored_posts
WHERE created_utc >= 1704067200 AND created_utc < 1704067200 + 2678400
  AND subreddit IN ('src3', 'src11') AND sentiment_label = 'positive'""")
def export_filtered(spark, sf):
    return agg.export_filtered(_all_scored(spark, sf), fx.START, fx.START + 2678400,
                               ["src3", "src11"], "positive")


@query("topk_scored", """
SELECT post_id, created_utc, sentiment_score FROM scored_posts
WHERE subreddit = 'src5' AND created_utc > 1704067200
ORDER BY sentiment_score DESC, post_id LIMIT 100""")
def topk_scored(spark, sf):
    return agg.top_scored(_all_scored(spark, sf), "src5", fx.START).select(
        "post_id", "created_utc", "sentiment_score")


@query("snapshot_reconcile", """
SELECT count(*) AS original_rows, count(*) FILTER (WHERE arrival_seq % 10 <> 3) AS copy_rows,
       max(created_utc) AS original_latest,
       max(created_utc) FILTER (WHERE arrival_seq % 10 <> 3) AS copy_latest,
       false AS same_content, false AS matches FROM posts""")
def snapshot_reconcile(spark, sf):
    p = fx.posts(spark, sf)
    return agg.snapshot_reconcile(p, p.filter(F.col("arrival_seq") % 10 != 3), "created_utc",
                                  ["post_id", "created_utc", "title"])


@query("confusion_matrix", """
SELECT CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END
         AS label, s.label AS prediction, count(*) AS n
FROM labels l JOIN scored s ON l.doc_id = s.arrival_seq GROUP BY 1, 2""")
def confusion_matrix(spark, sf):
    truth = fx.table(spark, sf, "labels").select(
        F.col("doc_id").alias("arrival_seq"),
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
        .otherwise("neutral").alias("label"))
    predicted = _score_columns(score(_composed(spark, sf), "text", _scorer(spark))) \
        .withColumnRenamed("label", "prediction")
    return agg.confusion_matrix(predicted, truth, "arrival_seq", "label", "prediction")
