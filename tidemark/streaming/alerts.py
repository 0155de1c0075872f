"""The alert state machine on a stream: hold time, no data, repeat interval, auto-resolve."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "alert STRING, t BIGINT, state STRING, since BIGINT, notify BOOLEAN"
_STATE = "since BIGINT, seen BIGINT, sent BIGINT, resolve_s BIGINT"
WATERMARK = "1 hour"


class AlertMachine(StatefulProcessor):
    """State of one alert: start of the breach, last point, last notification.

    Input rows are ``(alert, t, breach, for_s, resolve_s)``, one per alert and
    evaluation time. Each point gives its state. An alert from which nothing
    came for ``no_data_s`` gets the state NoData once, at that moment, and
    'resolved' ``resolve_s`` after its last point, if that is set; then all is
    forgotten. Both happen by timer when event time has passed the moment, or
    when a later point of the same micro-batch shows the gap, with the same
    rows: how points are cut into micro-batches does not matter.

    Frames are reduced to their times, verdicts and hold times as they come (33
    bytes a point), put in order, and evaluated as arrays.
    """

    def __init__(self, step_s: int, repeat_s: int, no_data_s: int | None = None):
        self.step_s, self.repeat_s, self.no_data_s = step_s, repeat_s, no_data_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("alert", _STATE)

    def _moments(self, last: int, resolve_s: int | None) -> list[tuple[int, str]]:
        """What a silence that begins after ``last`` leads to, and when."""
        moments = [] if self.no_data_s is None else [(last + self.no_data_s, "NoData")]
        return moments + ([] if resolve_s is None else [(last + resolve_s, "resolved")])

    def _reset_timers(self, last: int, resolve_s: int | None) -> None:
        if self.no_data_s is None:
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        for moment, _ in self._moments(last, resolve_s):
            self.handle.registerTimer(moment * 1000)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame],
                        timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        since, seen, sent, resolve_s = held if held else (None, None, None, None)
        parts = [tuple(frame[c].to_numpy() for c in ("t", "breach", "for_s", "resolve_s")) for frame in rows]
        t, breach, for_s, resolves = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(t, kind="stable")
        t, breach, for_s, resolves = t[order].astype(np.int64), breach[order].astype(bool), for_s[order].astype(np.int64), resolves[order]

        known = [None if pd.isna(x) else int(x) for x in resolves]
        # A silence that ends with a point of this batch, and what no timer has said about it yet.
        before = np.concatenate([[t[0] if seen is None else seen], t[:-1]])
        gap = t - before
        waiting = {x // 1000 for x in self.handle.listTimers()} if self.no_data_s is not None else set()
        silent, forgotten = [], np.zeros(len(t), bool)
        for i in np.flatnonzero(gap > self.step_s):
            for moment, state in self._moments(int(before[i]), resolve_s if i == 0 else known[i - 1]):
                if self.no_data_s is not None and moment < t[i] and (i or moment in waiting):
                    silent.append((moment, state))
                    forgotten[i] |= state == "resolved"

        was = np.concatenate([[since is not None], breach[:-1]])
        begins = breach & (~was | (gap > self.step_s))
        began = np.maximum.accumulate(np.where(begins, t, -1))
        began = np.where(began >= 0, began, -1 if since is None else since)
        state = np.where(~breach, "ok", np.where(t - began >= for_s, "firing", "pending"))
        notify = np.zeros(len(t), bool)
        firing = np.flatnonzero(state == "firing")
        at = 0
        while at < len(firing):  # one step per notification
            i = firing[at]
            if forgotten[(0 if sent is None else np.searchsorted(t, sent, side="right")):i + 1].any():
                sent = None
            if sent is None or t[i] - sent >= self.repeat_s:
                notify[i], sent = True, int(t[i])
            # The next one is an interval later, or the first after the alert was forgotten.
            later = np.searchsorted(t[firing], sent + self.repeat_s)
            again = np.flatnonzero(forgotten[i + 1:])
            if len(again):
                later = min(later, np.searchsorted(firing, i + 1 + again[0]))
            at = max(at + 1, later)
        if forgotten.any() and sent is not None and sent < t[np.flatnonzero(forgotten)[-1]]:
            sent = None

        last, resolve_s = int(t[-1]), known[-1]
        self.state.update((int(began[-1]) if breach[-1] else None, last, sent, resolve_s))
        self._reset_timers(last, resolve_s)
        yield pd.DataFrame({
            "alert": key[0], "t": np.concatenate([t, np.array([m for m, _ in silent], np.int64)]),
            "state": [*state, *[s for _, s in silent]],
            "since": pd.array([*np.where(breach, began, -1), *[-1] * len(silent)], "Int64"),
            "notify": [*notify, *[False] * len(silent)]}).assign(
                since=lambda x: x["since"].mask(x["since"] < 0))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        moment = expiredTimerInfo.getExpiryTimeInMs() // 1000
        held = self.state.get()
        for when, state in self._moments(held[1], held[3]) if held else []:
            if when == moment:
                if state == "resolved":
                    self.state.clear()
                yield pd.DataFrame({"alert": [key[0]], "t": [moment], "state": [state],
                                    "since": pd.array([None], "Int64"), "notify": [False]})

    def close(self) -> None:
        pass


def alert_stream(points: DataFrame, for_s: int | None, step_s: int, repeat_s: int,
                 no_data_s: int | None = None, watermark: str = WATERMARK) -> DataFrame:
    """State and notifications per evaluated point; needs the RocksDB state store.

    ``points`` have alert, t, breach, and for_s where that differs by alert;
    resolve_s (null: never) where alerts that stay silent resolve. With
    ``no_data_s`` silence is noticed by event time.
    """
    rows = points.select(
        "alert", "t", "breach", (F.col("for_s") if for_s is None else F.lit(for_s)).cast("bigint").alias("for_s"),
        (F.col("resolve_s") if "resolve_s" in points.columns else F.lit(None)).cast("double").alias("resolve_s"))
    mode = "none"
    if no_data_s is not None:
        rows = rows.withColumn("ts", F.timestamp_seconds("t")).withWatermark("ts", watermark)
        mode = "eventTime"
    return rows.groupBy("alert").transformWithStateInPandas(
        AlertMachine(step_s, repeat_s, no_data_s), OUTPUT, "append", mode)
