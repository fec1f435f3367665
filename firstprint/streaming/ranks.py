"""Weekly changes and ranks as keyed state: a late week changes what follows it and nothing else."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from firstprint.operators.store import overwrite_partition, read_store

NEAREST, FARTHEST = 5, 9  # days between the two rows of a weekly change
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def changes(days: np.ndarray, values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The change from the row before, and whether there is one: rows a week apart, both values known."""
    change, has = np.zeros(len(days)), np.zeros(len(days), bool)
    gap = np.diff(days)
    has[1:] = (gap >= NEAREST) & (gap <= FARTHEST) & known[1:] & known[:-1]
    change[1:][has[1:]] = np.diff(values)[has[1:]]
    return change, has


def percents_from(first: int, values: np.ndarray, known: np.ndarray, least: int) -> list[float | None]:
    """The percent of earlier known values strictly below each, from row `first` on."""
    seen = sorted(values[:first][known[:first]].tolist())
    found: list[float | None] = []
    for value, here in zip(values[first:].tolist(), known[first:].tolist()):
        found.append(100.0 * bisect_left(seen, value) / len(seen) if here and len(seen) >= max(least, 1) else None)
        if here:
            insort(seen, value)
    return found


def merged(days: np.ndarray, values: np.ndarray, known: np.ndarray, new: dict[int, float | None]) -> tuple[np.ndarray, ...]:
    """The weeks of a series with new ones in their places, and the place of the first new one."""
    added = np.array(sorted(new), np.int64)
    fresh = np.array([0.0 if new[d] is None else new[d] for d in added.tolist()], float)
    there = np.array([new[d] is not None for d in added.tolist()], bool)
    both = np.concatenate([days, added])
    order = np.argsort(both, kind="stable")
    first = int(np.searchsorted(days, added[0])) if len(added) else len(days)
    return both[order], np.concatenate([values, fresh])[order], np.concatenate([known, there])[order], first


class WeeklyRanks(StatefulProcessor):
    """A series' weeks, kept by calendar year. A batch rewrites the years it adds to and returns the weeks from its first on."""

    def __init__(self, series: str, arrival: str, min_history: int):
        self.series, self.arrival, self.min_history = series, arrival, min_history

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.years = handle.getMapState("years", "year int", "days binary, nets binary, known binary")

    def handleInputRows(self, key, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stored = {year[0]: kept for year, kept in self.years.iterator()}
        parts = [stored[year] for year in sorted(stored)]
        days, nets, known = (np.concatenate([np.frombuffer(p[i], kind) for p in parts]) if parts else np.empty(0, kind)
                             for i, kind in enumerate(("<i8", "<f8", "?")))
        have, arrived, new = set(days.tolist()), {}, {}
        for frame in rows:
            at = pd.to_datetime(frame["report_date"], errors="coerce")
            for day, net, order in zip(at, frame["net"], frame[self.arrival]):
                if pd.isna(day) or (day := (day - pd.Timestamp(0)).days) in have:
                    continue  # the first print stays
                if day not in arrived or order < arrived[day]:
                    arrived[day], new[day] = order, None if pd.isna(net) else float(net)
        if not new:
            return
        days, nets, known, first = merged(days, nets, known, new)
        year = days.astype("datetime64[D]").astype("datetime64[Y]").astype(int) + 1970
        for touched in sorted({int(y) for d, y in zip(days.tolist(), year) if d in new}):
            mine = year == touched
            self.years.updateValue((touched,), (days[mine].tobytes(), nets[mine].tobytes(), known[mine].tobytes()))
        change, moved = changes(days, nets, known)
        shown = lambda numbers, there: [x if ok else None for x, ok in zip(numbers[first:].tolist(), there[first:].tolist())]
        yield pd.DataFrame({
            self.series: [key[0]] * (len(days) - first), "report_date": days[first:].astype("datetime64[D]").astype(str),
            "net": shown(nets, known), "net_change": shown(change, moved),
            "move_rank_pct": percents_from(first, np.abs(change), moved, self.min_history),
            "net_rank_pct": percents_from(first, nets, known, self.min_history)}, dtype=object)

    def close(self) -> None:
        pass


def stream_gap_delta_rank(stream: DataFrame, path: str, checkpoint: str, series: str, arrival: str, min_history: int = 52,
                          slices: int = 64) -> StreamingQuery:
    """Weekly change and ranks of every series as a stored table under `path`/ranked, kept up as weeks arrive.

    Columns of the stream: the series, report_date (yyyy-MM-dd), net and the arrival order within a batch; rows without a
    series or a date are left out. Each series is keyed state: its weeks by year, first prints only. A batch wakes the
    series it has weeks for; what follows the first new week of a series is worked out again and replaces the stored rows,
    in the slices and years that hold them. So a late week corrects what follows it, the newest week touches one year, and a
    replayed week or batch changes nothing. A missing net neither ranks nor counts.
    """
    spark, ranked = stream.sparkSession, f"{path}/ranked"
    kind = stream.schema[series].dataType.simpleString()
    schema = f"`{series}` {kind}, report_date string, net double, net_change double, move_rank_pct double, net_rank_pct double"
    changed = stream.where(F.col(series).isNotNull() & F.col("report_date").isNotNull()).select(
        series, "report_date", "net", arrival).groupBy(series).transformWithStateInPandas(
        WeeklyRanks(series, arrival, min_history), schema, "Update", "None")

    def replace(batch: DataFrame, _epoch: int) -> None:
        rows = batch.withColumns({"part": F.pmod(F.xxhash64(series), F.lit(slices)).cast("string"),
                                  "year": F.substring("report_date", 1, 4)}).persist()
        try:
            stored = read_store(batch.sparkSession, ranked)
            whole = rows
            if stored is not None:
                stored = stored.select([F.col(c).cast(rows.schema[c].dataType) for c in rows.columns])
                kept = stored.join(rows.select("part", "year").distinct(), ["part", "year"], "left_semi")
                kept = kept.join(rows.select(series, "report_date"), [series, "report_date"], "left_anti")
                whole = rows.unionByName(kept)
            overwrite_partition(whole, ranked, ["part", "year"])
        finally:
            rows.unpersist()

    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)  # keyed maps need it; the started query keeps it
    try:
        return (changed.writeStream.outputMode("update").foreachBatch(replace).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)
