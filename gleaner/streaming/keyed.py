"""Ledger operators on streams, on Spark's keyed state (`transformWithState`).

Each key keeps what its next row needs: a count, an open streak, its newest rows.  Keys have no common clock: a row of one
key is never late because another key is ahead.  Rows of a key that arrive together are taken in time order; one that
arrives after a newer row of its own key is counted when it arrives, `late` marks it, and what was given out before
stays.

Keys are dealt into `BUCKETS` buckets by hash and Spark's state is kept per bucket, as one packed table of its keys: a
micro-batch calls Python once for each bucket it touches, not once for each key, and works on all its keys by columns.
The number of buckets belongs to a stream's checkpoint and must stay.  A micro-batch's rows of a bucket are ordered in
memory, so `maxFilesPerTrigger` should bound batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gleaner.operators.repair import classify_failure
from gleaner.vocabulary import ATTEMPT_CAP, LEDGER_WINDOW

#: buckets of keys
BUCKETS = 512
#: stands for a time that is not known
_NEVER = np.iinfo("int64").min


def _micros(times: pd.Series) -> pd.Series:
    """Microseconds of each time, `_NEVER` for none."""
    return pd.Series(pd.to_datetime(times).to_numpy().astype("datetime64[us]").astype("int64"), index=times.index)


class Packed:
    """A table of a bucket's keys, as one value of Spark's state."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, columns: dict[str, str]):
        self._value, self._columns = handle.getValueState(name, "packed BINARY"), columns

    def get(self) -> pd.DataFrame:
        if not self._value.exists():
            return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in self._columns.items()})
        return pa.ipc.open_stream(bytes(self._value.get()[0])).read_pandas()

    def put(self, rows: pd.DataFrame) -> None:
        if rows.empty:
            self._value.clear()
            return
        table, sink = pa.Table.from_pandas(rows[list(self._columns)], preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self._value.update((sink.getvalue().to_pybytes(),))


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """A bucket's new rows by time and id (null times first)."""
    return pd.concat(list(rows), ignore_index=True).sort_values(["at_time", "at_id"], na_position="first", ignore_index=True)


class InOrder(StatefulProcessor):
    """Hands over a bucket's new rows in order with the `value` their key had, and marks rows older than its newest."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._keys = Packed(handle, "keys", {"in_key": "object", "newest": "int64", "value": "int64"})

    def arrived(self, rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
        df = _in_order(rows)
        self._known = self._keys.get().set_index("in_key")
        self._times = _micros(df["at_time"])
        newest = df["in_key"].map(self._known["newest"]).fillna(_NEVER).astype("int64")
        df["late"] = (self._times != _NEVER) & (self._times < newest)
        df["value"] = df["in_key"].map(self._known["value"]).fillna(0).astype("int64")
        return df

    def keep(self, df: pd.DataFrame, value: pd.Series) -> None:
        """Keep each key's newest time and the value of its last row."""
        now = pd.DataFrame({"in_key": df["in_key"], "newest": self._times, "value": value}).groupby("in_key").agg(
            newest=("newest", "max"), value=("value", "last"))
        before = self._known["newest"].reindex(now.index)
        now["newest"] = np.maximum(now["newest"], before.where(before.notna(), _NEVER).astype("int64"))
        others = self._known[~self._known.index.isin(now.index)]
        self._keys.put(pd.concat([others, now]).rename_axis("in_key").reset_index())


class _Attempts(InOrder):
    def __init__(self, cap: int):
        self.cap = cap

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        df = self.arrived(rows)
        df["n_counted"] = df["value"] + df.groupby("in_key")["counted"].cumsum()
        self.keep(df, df["n_counted"])
        df["terminal"] = df["n_counted"] >= self.cap
        df["flips"] = (df["counted"] == 1) & (df["n_counted"] == self.cap)
        yield df


class _Breaker(InOrder):
    def __init__(self, threshold: int):
        self.threshold = threshold

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        df = self.arrived(rows)
        bad = df["status"] == "degraded"
        runs = (~bad).astype("int64").groupby(df["in_key"]).cumsum()
        streak = bad.astype("int64").groupby([df["in_key"], runs]).cumsum() + (bad & (runs == 0)) * df["value"]
        self.keep(df, streak)
        yield df.assign(bad_streak=streak, circuit_open=streak >= self.threshold)


class _Stalls(InOrder):
    SEEN = {"in_key": "object", "scheduled": "bool", "checked": "float64", "ingested": "float64"}

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self._seen = Packed(handle, "seen", self.SEEN)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        df = self.arrived(rows)
        self.keep(df, df["value"])
        new = pd.DataFrame({"in_key": df["in_key"], "scheduled": df["kind"] == "scheduled",
                            "checked": df["sources_checked"].astype("float64"), "ingested": df["ingested"].astype("float64")})
        seen = self._seen.get()
        both = pd.concat([seen, new], ignore_index=True) if len(seen) else new
        # rows of a key one after the other, older ones first; `back` turns a key's rows into the order they came in
        order = np.argsort(pd.factorize(both["in_key"])[0], kind="stable")
        back = np.empty(len(both), "int64")
        back[order] = np.arange(len(both))
        both = both.iloc[order].reset_index(drop=True)
        at = pd.Series(np.arange(len(both)))

        def before(marked: pd.Series) -> np.ndarray:
            """Place of the key's last marked row among the `LEDGER_WINDOW` before each row, -1 for none."""
            last = at.where(marked).groupby(both["in_key"]).ffill().groupby(both["in_key"]).shift().fillna(-1).astype("int64")
            return np.where(at - last <= LEDGER_WINDOW, last, -1)

        checked, ingested = both["checked"].to_numpy(), both["ingested"].to_numpy()
        previous = before(both["scheduled"])
        some = previous >= 0
        checked_before = np.where(some, checked[previous], np.nan)
        ingested_before = np.where(some, ingested[previous], np.nan)
        fetched_before = before(both["checked"] > 0) >= 0
        no_ingest = (checked > 0) & (ingested == 0) & (checked_before > 0) & (ingested_before == 0)
        no_fetch = (checked == 0) & (checked_before == 0) & fetched_before
        self._seen.put(both.groupby("in_key").tail(LEDGER_WINDOW))
        done = ((df["kind"] == "scheduled") & (df["status"] == "completed")).to_numpy()
        mine = back[len(both) - len(df):]
        yield df.assign(ingestion_stall=done & no_ingest[mine], fetch_stall=done & no_fetch[mine])


class _Windows(StatefulProcessor):
    OPEN = {"in_key": "object", "profile": "object", "rejected": "bool", "tags": "object"}

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = Packed(handle, "open", self.OPEN)
        self._closed = Packed(handle, "closed", {"in_key": "object", "n": "int64"})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new, waiting = _in_order(rows)[list(self.OPEN)], self._open.get()
        runs = pd.concat([waiting, new], ignore_index=True) if len(waiting) else new
        number = runs.groupby("in_key").cumcount()
        full = runs.groupby("in_key")["in_key"].transform("size") // self.n * self.n
        closed = self._closed.get().set_index("in_key")["n"]
        out = runs.assign(window_id=runs["in_key"].map(closed).fillna(0).astype("int64") + number // self.n)[number < full]
        self._open.put(runs[number >= full])
        if len(out):
            now = out.groupby("in_key")["window_id"].max() + 1
            both = pd.concat([closed[~closed.index.isin(now.index)], now.rename("n")])
            self._closed.put(both.rename("n").rename_axis("in_key").reset_index())
            yield out[["profile", "window_id", "rejected"]].assign(
                tags=[None if t is None else list(t) for t in out["tags"]])


class _Deadlines(StatefulProcessor):
    """Starts wait in state for a finished row of their id, under one timer at the earliest deadline of the bucket."""

    def __init__(self, deadline: timedelta):
        self.span = deadline // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._starts = Packed(handle, "starts", {"run_id": "object", "profile": "object", "at": "int64"})
        self._done = Packed(handle, "done", {"run_id": "object", "at": "int64"})

    def _wait(self, starts: pd.DataFrame, done: pd.DataFrame) -> None:
        """Keep what is open; a finished row that came first waits as long as its start may still be within the deadline."""
        self._starts.put(starts)
        self._done.put(done)
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        early = done.loc[~done["run_id"].isin(starts["run_id"])].groupby("run_id")["at"].max()
        if len(starts) or len(early):
            self._handle.registerTimer((int(min([*starts["at"].nsmallest(1), *early.nsmallest(1)])) + self.span) // 1000)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows), ignore_index=True)
        df["at"] = _micros(df["at"])
        # starts known already come first, then the earliest of those that arrive together
        starts = pd.concat([self._starts.get(), df.loc[~df["finished"], ["run_id", "profile", "at"]].sort_values("at")],
                           ignore_index=True).drop_duplicates("run_id")
        done = pd.concat([self._done.get(), df.loc[df["finished"], ["run_id", "at"]]], ignore_index=True)
        begun = done["run_id"].map(starts.set_index("run_id")["at"])
        over = done.loc[(done["at"] >= begun) & (done["at"] - begun <= self.span), "run_id"]
        self._wait(starts[~starts["run_id"].isin(over)], done[~done["run_id"].isin(over)])
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        starts, done = self._starts.get(), self._done.get()
        past = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        due = (starts["at"] + self.span) // 1000 <= past
        early = done.loc[~done["run_id"].isin(starts["run_id"])].groupby("run_id")["at"].max()
        over = [*starts.loc[due, "run_id"], *early.index[(early + self.span) // 1000 <= past]]
        self._wait(starts[~due], done[~done["run_id"].isin(over)])
        if due.any():
            yield starts.loc[due, ["run_id", "profile"]].assign(
                started_at=starts.loc[due, "at"].astype("datetime64[us]"), status="abandoned")


def _as_text(fields: Sequence[T.StructField]) -> list[Column]:
    """The fields with whole numbers as text: pandas would turn them into floats beside nulls of other keys."""
    return [F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.LongType) else F.col(f.name)
            for f in fields]


def _keyed(stream: DataFrame, keys: Sequence[str], processor: StatefulProcessor, fields: T.StructType,
           buckets: int, mode: str = "None") -> DataFrame:
    """Run a processor per bucket of keys; whole numbers that it only passes on go through it as text."""
    plain = T.StructType([T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.LongType)
                          and f.name in stream.columns else f for f in fields])
    out = stream.withColumn("in_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).groupBy(
        "in_bucket").transformWithStateInPandas(processor, plain, "Append", mode)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _in_time(stream: DataFrame, keys: Sequence[str], time: str, id: str) -> DataFrame:
    """The stream's columns and some of its own for `_in_order`: key, time and id, exact for numbers beside nulls."""
    number = isinstance(stream.schema[id].dataType, (T.LongType, T.IntegerType))
    at = F.coalesce(F.col(id), F.lit(_NEVER)).cast("long") if number else F.col(id)
    return stream.select(
        *_as_text(stream.schema.fields), F.to_json(F.struct(*keys)).alias("in_key"), F.col(time).alias("at_time"), at.alias("at_id"))


def _and(stream: DataFrame, more: str) -> T.StructType:
    """The stream's columns, `late` and more."""
    return T.StructType([*stream.schema.fields, *T._parse_datatype_string(f"late BOOLEAN, {more}")])


def attempts(stream: DataFrame, cap: int = ATTEMPT_CAP, buckets: int = BUCKETS) -> DataFrame:
    """Failures counted so far per note and stage, whether the cap is reached, and the one row that reaches it."""
    counted = F.coalesce((classify_failure(F.col("failure_stage")) == "counted").cast("int"), F.lit(0))
    rows = _in_time(stream.withColumn("counted", counted), ["note_id", "stage"], "ts", "attempt_id")
    return _keyed(rows, ["note_id", "stage"], _Attempts(cap),
                  _and(stream, "n_counted BIGINT, terminal BOOLEAN, flips BOOLEAN"), buckets)


def breaker(stream: DataFrame, threshold: int = 3, buckets: int = BUCKETS) -> DataFrame:
    """Degraded probes in a row and whether the target's breaker is open after each one."""
    return _keyed(_in_time(stream, ["target"], "ts", "probe_id"), ["target"], _Breaker(threshold),
                  _and(stream, "bad_streak BIGINT, circuit_open BOOLEAN"), buckets)


def stalls(stream: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Stall flags of each run as in `ledger.stall_flags`, from the profile's newest rows."""
    return _keyed(_in_time(stream, ["profile"], "completed_at", "run_id"), ["profile"], _Stalls(),
                  _and(stream, "ingestion_stall BOOLEAN, fetch_stall BOOLEAN"), buckets)


def closed_windows(stream: DataFrame, n: int, tags: Column, rejected: Column, buckets: int = BUCKETS) -> DataFrame:
    """(profile, window_id, rejected, tags) of the completed runs of every window of n, once it is full.

    All runs of a window come in one micro-batch, so `reports.rejection_rates` of the batch is final.
    """
    rows = stream.where(F.col("status") == "completed").select(
        "profile", "run_id", "completed_at", F.coalesce(rejected, F.lit(False)).alias("rejected"), tags.alias("tags"))
    fields = T.StructType([rows.schema["profile"], *T._parse_datatype_string("window_id BIGINT, rejected BOOLEAN"),
                           rows.schema["tags"]])
    return _keyed(_in_time(rows, ["profile"], "completed_at", "run_id"), ["profile"], _Windows(n), fields, buckets)


def abandoned(starts: DataFrame, finished: DataFrame, deadline: timedelta = timedelta(hours=6),
              delay: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """(run_id, profile, started_at, status) of each start that no finished row of its id follows within the deadline.

    It is told by a timer when the watermark (newest time of either stream less `delay`) passes the deadline; no row
    of that id has to come.  Of several starts of an id the first to arrive counts (the earliest of those that arrive
    together); any finished row within the deadline ends it.  Rows without id or time never start or finish anything.
    """
    both = starts.select("run_id", F.col("profile").cast("string").alias("profile"), F.col("started_at").alias("at"),
                         F.lit(False).alias("finished")).unionByName(
        finished.select("run_id", F.lit(None).cast("string").alias("profile"), F.col("completed_at").alias("at"),
                        F.lit(True).alias("finished")))
    rows = both.where("run_id is not null and at is not null").withWatermark("at", delay)
    fields = T.StructType([rows.schema["run_id"], *T._parse_datatype_string(
        "profile STRING, started_at TIMESTAMP, status STRING")])
    return _keyed(rows.withColumn("run_id", F.col("run_id").cast("string")), ["run_id"], _Deadlines(deadline), fields,
                  buckets, "EventTime")
