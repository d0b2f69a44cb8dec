"""Tracks from streams."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.tracks import CARRIED, RECORD, Tracker, frames_of, record

KEPT = [*CARRIED, "confidence", "entities"]


def session_tracks(stream: DataFrame, keys: list[str], at: str, gap: str, watermark: str | None = None) -> DataFrame:
    """Runs of events with equal keys, split where event time jumps by more than the gap."""
    rows = stream.withWatermark(at, watermark) if watermark else stream
    w = F.session_window(F.col(at), gap)
    return rows.groupBy(*keys, w.alias("w")).agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("occurrences"))


def greedy_track_stream(stream: DataFrame, threshold: float = 0.85, max_gap: int = 120) -> DataFrame:
    """Records of a stream of detections (schema DETECTION, frames of a video in order across batches), in append mode.

    State is a video's open tracks. Tracks come out when a later frame closes them; those open at the end stay in
    state until more frames come or the stream sends a row with a null text, which flushes its video.
    """
    names = [c.split()[0] for c in RECORD.split(", ")]
    state = "tracks string"

    def run(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        tracker = Tracker(threshold, max_gap, json.loads(held.get[0]) if held.exists else None)
        rows = pd.concat(list(parts), ignore_index=True)
        flush, done = rows["text"].isna().any(), []
        for idx, found in frames_of(rows[rows["text"].notna()]):
            done += tracker.frame(idx, [{c: d[c] for c in KEPT} for d in found])
        if flush:
            done, tracker.open = done + tracker.open, []
        held.update((json.dumps(tracker.open),))
        yield pd.DataFrame([record(key[0], t) for t in done], columns=names)

    return stream.groupBy("video_id").applyInPandasWithState(run, RECORD, state, "append", GroupStateTimeout.NoTimeout)


#: transformWithState needs this store.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class OpenTracks(StatefulProcessor):
    """The open tracks of a video as a list state, one entry a track, and a timer for the first of them that can close."""

    def __init__(self, threshold: float, max_gap: int, gap_ms: int):
        self.threshold, self.max_gap, self.gap_ms = threshold, max_gap, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "track string")

    def _told(self, video: str, done: list[dict]) -> Iterator[pd.DataFrame]:
        if done:
            yield pd.DataFrame([record(video, t) for t in done], columns=[c.split()[0] for c in RECORD.split(", ")])

    def _keep(self, tracks: list[dict]) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not tracks:
            self.open.clear()
            return
        self.open.put([(json.dumps(t),) for t in tracks])
        self.handle.registerTimer(min(t["last"]["at_ms"] for t in tracks) + self.gap_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tracker = Tracker(self.threshold, self.max_gap, [json.loads(t[0]) for t in self.open.get()])
        parts, done = pd.concat(list(rows), ignore_index=True), []
        for idx, found in frames_of(parts[parts["text"].notna()]):
            done += tracker.frame(idx, [{c: d[c] for c in [*KEPT, "at_ms"]} for d in found])
        self._keep(tracker.open)
        yield from self._told(key[0], done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        tracks = [json.loads(t[0]) for t in self.open.get()]
        over = [t["last"]["at_ms"] + self.gap_ms <= now for t in tracks]
        self._keep([t for t, o in zip(tracks, over, strict=True) if not o])
        yield from self._told(key[0], [t for t, o in zip(tracks, over, strict=True) if o])

    def close(self) -> None:
        pass


def timed_tracks(stream: DataFrame, at: str, watermark: str, threshold: float = 0.85, max_gap: int = 120, gap_ms: int = 5000) -> DataFrame:
    """Records of a stream of detections (schema DETECTION and the event time `at`), in append mode.

    A track closes when a frame comes more than max_gap after its last, or when the watermark is gap_ms past its last detection; gap_ms is the time that
    max_gap frames take, or more. Then its state goes, so state is as large as what is open. Frames of a video come in order; rows
    later than the watermark are dropped. Rows with a null text move time on and are no detections. Records are those of greedy_tracks. The
    session's state store has to be RocksDB (spark.sql.streaming.stateStore.providerClass, see ROCKSDB).
    """
    rows = stream.withColumn("at_ms", F.unix_millis(at)).withWatermark(at, watermark)
    return rows.groupBy("video_id").transformWithStateInPandas(OpenTracks(threshold, max_gap, gap_ms), RECORD, "Append", "EventTime")
