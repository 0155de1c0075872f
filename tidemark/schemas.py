"""Row types of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B, _TS = (T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(),
                       T.TimestampType())
_LABELS = T.MapType(_S, _S)


def _row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


POST = _row(post_id=_S, title=_S, content=_S, score=_L, created_utc=_L, subreddit=_S, url=_S,
            num_comments=_L)

SENTIMENT = _row(label=_S, confidence=_D, positive=_D, negative=_D, neutral=_D)

#: The written table, in its column order.
SCORED_POST = T.StructType([
    *POST.fields,
    *_row(sentiment_label=_S, sentiment_confidence=_D, sentiment_positive=_D,
          sentiment_negative=_D, sentiment_neutral=_D, sentiment_score=_D, run_id=_S).fields,
])
SCORED_COLUMNS = SCORED_POST.names

SEEN = _row(post_id=_S, content_hash=_S, title=_S, subreddit=_S, created_utc=_L,
            first_seen_utc=_L)

SAMPLE = _row(metric=_S, labels=_LABELS, ts=_TS, value=_D)

ALERT_PAYLOAD = _row(
    receiver=_S, status=_S,
    alerts=T.ArrayType(_row(status=_S, labels=_LABELS, annotations=_LABELS, startsAt=_S, endsAt=_S,
                            generatorURL=_S)),
    groupLabels=_LABELS, commonLabels=_LABELS, commonAnnotations=_LABELS)

LOG_RECORD = _row(asctime=_S, name=_S, levelname=_S, pathname=_S, lineno=_L, funcName=_S,
                  process=_L, thread=_L, message=_S)

HEALTH = _row(component=_S, ts=_TS, healthy=_B, message=_S)

MANIFEST = _row(snapshot=_S, path=_S, length=_L, checksum=_S, modified=_TS)

#: The two rows used when no input is configured (fixed values).
SAMPLE_POSTS = [
    ("dummy_1", "Bitcoin price rising!", "Great news for crypto investors", 150, 1640995200,
     "Bitcoin", "https://reddit.com/dummy1", 25),
    ("dummy_2", "Ethereum looks bearish", "Market sentiment is uncertain", 75, 1640995260,
     "ethereum", "https://reddit.com/dummy2", 12),
]
