"""Stateful streaming: timers, ordered per-rollout state, counted late rows.

Rows behind the watermark are not dropped unseen here: the operators get them and
say what became of them. The watermark is kept on a column that the operator does
not see, so that Spark passes such rows on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from verdictlake.functions.canonical import call_key
from verdictlake.streaming.feeds import TERMINAL

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession) -> SparkSession:
    """A sibling session whose streams keep state in RocksDB. The number of
    state partitions stays with a checkpoint for life: it is what the session says."""
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return sibling


REPLAYED = ["rollout_id", "seq", "name", "result_id", "want_id", "error", "want_error", "after_gap"]


class _ReplayState(StatefulProcessor):
    """Replays a rollout's calls in ``seq`` order. Calls that arrive ahead of a
    gap wait in map state; re-sent ones are dropped. A timer behind the latest
    call releases what still waits, in order and marked, and ends the state."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", "next_seq int, segment int, version bigint, failed array<string>, timer bigint")
        self.waiting = handle.getMapState(
            "waiting", "seq int", "name string, call string, seed bigint, planted array<string>, "
            "external boolean, result_id string, error string, segment int, start bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        next_seq, segment, version, failed, timer = self.progress.get() if self.progress.exists() else (0, None, 0, [], 0)
        state, latest = (segment, version, set(failed)), 0
        for chunk in rows:
            found = []
            latest = max(latest, int(chunk["at_ms"].max()))
            for row in chunk.sort_values("seq").itertuples(index=False):
                fields = (row.name, row.call, int(row.seed), list(row.planted), bool(row.external),
                          row.result_id, row.error, int(row.segment), int(row.start))
                if row.seq > next_seq:
                    self.waiting.updateValue((int(row.seq),), fields)
                    continue
                if row.seq < next_seq:
                    continue
                while fields is not None:
                    outcome, state = self._step(fields, state)
                    found.append((key[0], next_seq, *outcome, False))
                    next_seq += 1
                    fields = self._take(next_seq)
            yield pd.DataFrame(found, columns=REPLAYED)
        if latest + self.wait_ms > timer:
            if timer:
                self.handle.deleteTimer(timer)
            timer = latest + self.wait_ms
            self.handle.registerTimer(timer)
        self.progress.update((next_seq, state[0], state[1], sorted(state[2]), timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, segment, version, failed, _ = self.progress.get()
        state, found = (segment, version, set(failed)), []
        for (seq,), fields in sorted((tuple(k), tuple(v)) for k, v in self.waiting.iterator()):
            outcome, state = self._step(fields, state)
            found.append((key[0], seq, *outcome, True))
        self.waiting.clear()
        self.progress.clear()
        yield pd.DataFrame(found, columns=REPLAYED)

    def _take(self, seq: int):
        if not self.waiting.containsKey((seq,)):
            return None
        fields = self.waiting.getValue((seq,))
        self.waiting.removeKey((seq,))
        return tuple(fields)

    @staticmethod
    def _step(fields, state):
        name, call, seed, planted, external, result_id, error, segment, start = fields
        if segment != state[0]:  # the server sent a new sandbox
            state = (segment, start, set())
        _, version, failed = state
        # A report that succeeded does not consume a planted fault.
        faulted = name in planted and name not in failed and (not external or error is not None)
        after = (segment, version, failed | {name} if faulted else failed)
        if external:
            return (name, result_id, result_id, error, error), after
        if faulted:
            return (name, result_id, None, error, f"{name} is unavailable"), after
        text = f"{call}, {version}, {seed}]"
        return (name, result_id, hashlib.sha256(text.encode()).hexdigest()[:8], error, None), (segment, version + 1, after[2])

    def close(self) -> None:
        pass


def stream_replay_check(events: DataFrame, wait_seconds: int = 3600, delay: str = "1 minute") -> DataFrame:
    """Calls whose reported output differs from the replayed one, live.

    ``events(rollout_id, seq, name, input, segment, seed, planted, start, external,
    result_id, error, at)``: events joined with the sandbox their turn runs on (a
    stream-static join); a new ``segment`` sets state and faults anew. ``seq``
    starts at 0 in every rollout. Calls behind a missing ``seq``
    are held until the watermark passes the rollout's latest call by
    ``wait_seconds``, then compared as if it had never been, with ``after_gap``;
    the rollout's state ends there too.
    """
    key = events.schema["rollout_id"].dataType.simpleString()
    called = (events.withWatermark("at", delay).withColumn("at_ms", F.unix_millis("at"))
              .withColumn("call", call_key(F.col("name"), F.col("input"))).drop("input", "at"))
    replayed = called.groupBy("rollout_id").transformWithStateInPandas(
        _ReplayState(wait_seconds * 1000), f"rollout_id {key}, seq int, name string, result_id string, want_id string, "
        "error string, want_error string, after_gap boolean", outputMode="Append", timeMode="EventTime")
    return replayed.filter("NOT (result_id <=> want_id AND error <=> want_error)")


STATUS_COLUMNS = ["run_id", "status", "last_seq", "step"]


def _status_step(timeout_ms: int, flag: bool) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Latest status of a run; an event-time timeout ends the state of a run that
    goes quiet, and flags it first if it has not finished and ``flag`` is set. A
    run's state comes and goes with its rows, so a run costs no further call."""

    def quiet(key, state: GroupState, seq, ended, last_ms) -> list[tuple]:
        if ended is not None or not flag:
            state.remove()
            return []
        state.update((seq, "timed_out", None, last_ms))
        return [(key[0], "timed_out", seq, 1)]

    def step(key, rows, state: GroupState) -> Iterator[pd.DataFrame]:
        seq, status, ended, last_ms = state.get if state.exists else (-1, None, None, 0)
        if state.hasTimedOut:
            found = quiet(key, state, seq, ended, last_ms)
        else:
            for chunk in rows:
                for n, said, at_ms in zip(chunk["seq"], chunk["status"], chunk["created_ms"]):
                    if at_ms > last_ms:
                        last_ms = int(at_ms)
                    # The earliest terminal status stays, whenever it arrives.
                    if said in TERMINAL and (ended is None or n < ended):
                        ended, status = int(n), said
                    elif ended is None and n > seq:
                        status = said
                    if n > seq:
                        seq = int(n)
            found, due = [(key[0], status, seq, 0)], last_ms + timeout_ms
            if due <= state.getCurrentWatermarkMs():
                found += quiet(key, state, seq, ended, last_ms)
            else:
                state.update((seq, status, ended, last_ms))
                state.setTimeoutTimestamp(max(due - 1, 1))  # over once the watermark is beyond this
        if found:
            yield pd.DataFrame(found, columns=STATUS_COLUMNS, dtype=object)
    return step


def _statuses(events: DataFrame, quiet_seconds: int, flag: bool, delay: str) -> DataFrame:
    key = events.schema["run_id"].dataType.simpleString()
    marked = events.withWatermark("created_at", delay).withColumn("created_ms", F.unix_millis("created_at"))
    return marked.groupBy("run_id").applyInPandasWithState(
        _status_step(quiet_seconds * 1000, flag), f"run_id {key}, status string, last_seq bigint, step int",
        "seq bigint, status string, ended bigint, last_ms bigint", "update", GroupStateTimeout.EventTimeTimeout)


def stream_run_status(events: DataFrame, keep_seconds: int = 7 * 86400, delay: str = "1 minute") -> DataFrame:
    """Latest status per run; the first terminal status outranks later events. A
    run that is quiet for ``keep_seconds`` of event time is over: its last row
    stands, and its state goes."""
    return _statuses(events, keep_seconds, False, delay).drop("step")


def stream_stalled_runs(events: DataFrame, timeout_seconds: int, delay: str = "1 minute") -> DataFrame:
    """Run status with ``timed_out`` once the watermark passes the last event of
    an unfinished run by ``timeout_seconds``. ``step`` orders the two rows that a
    run may have in one micro-batch."""
    return _statuses(events, timeout_seconds, True, delay)


class _UsageCounts(StatefulProcessor):
    """Counts a bucket's requests as they come in; once the watermark has passed
    the bucket's end, they are late."""

    def __init__(self, bucket_ms: int):
        self.bucket_ms = bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        late = key[0] + self.bucket_ms <= timerValues.getCurrentWatermarkInMs()
        requests = errors = 0
        for chunk in rows:
            requests += len(chunk)
            errors += int((chunk["status"] >= 400).sum())
        on_time = (requests, errors, 0) if not late else (0, 0, requests)
        yield pd.DataFrame([(key[0], *on_time)], columns=["bucket_ms", "requests", "errors", "late"])

    def close(self) -> None:
        pass


def stream_usage(requests: DataFrame, bucket_seconds: int, delay: str, shards: int = 16) -> DataFrame:
    """Counts per time bucket, handed out as they come in (`feeds.summed` adds
    them up): ``requests`` and ``errors`` in time, ``late`` the requests that
    arrive when the watermark has passed their bucket's end. None is lost, and no
    state is kept. A busy bucket is spread over ``shards`` keys."""
    bucket = F.floor(F.unix_millis("created_at") / (bucket_seconds * 1000)) * (bucket_seconds * 1000)
    counted = (requests.withWatermark("created_at", delay)
               .select(bucket.alias("bucket_ms"), F.pmod(F.xxhash64("created_at", "status"), F.lit(shards)).alias("shard"), "status"))
    return counted.groupBy("bucket_ms", "shard").transformWithStateInPandas(
        _UsageCounts(bucket_seconds * 1000), "bucket_ms bigint, requests bigint, errors bigint, late bigint",
        outputMode="Append", timeMode="EventTime")


NO_TIME = 2 ** 62
VERDICT = ["check", "rollout", "seq"]
PACKED_ROWS = 1 << 20
ALIKE = 8
PLAIN = ("tinyint", "smallint", "int", "bigint", "string", "date", "timestamp", "timestamp_ntz", "boolean", "binary")


def _comparable(rows: DataFrame, name: str) -> Column:
    """The column as Arrow can tell its values apart; nested ones and fractions as JSON."""
    kind = rows.schema[name].dataType.simpleString()
    if kind in PLAIN or kind.startswith("decimal"):
        return F.col(name)
    return F.to_json(F.struct(name), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def _planes(values: np.ndarray) -> bytes:
    """Integers as steps from one to the next, less what all steps are multiples of,
    with the bytes of equal weight side by side: little for zstd to keep."""
    steps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    inner = steps[1:]
    unit = np.gcd.reduce(inner) if len(inner) and np.abs(inner // 2).max() < 2 ** 61 else np.int64(1)
    unit = max(int(unit), 1)
    steps[1:] = inner // unit
    signed = (steps << 1) ^ (steps >> 63)
    return np.array([unit], "<i8").tobytes() + signed.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _integers(planes: bytes) -> np.ndarray:
    unit, signed = np.frombuffer(planes, "<i8", 1)[0], np.frombuffer(planes, np.uint8, offset=8).reshape(8, -1).T.copy().view("<u8").ravel()
    steps = (signed >> np.uint64(1)).view(np.int64) ^ -(signed & np.uint64(1)).view(np.int64)
    steps[1:] *= unit
    return np.cumsum(steps)


def _pack(rows: pa.Table) -> bytes:
    rows = rows.combine_chunks()
    whole = [f.name for f in rows.schema if pa.types.is_integer(f.type) and not rows[f.name].null_count and len(rows)]
    row = {c: [_planes(rows[c].to_numpy())] for c in whole}
    raw = _stream(pa.table({"_schema": [rows.schema.serialize().to_pybytes()], "_rest": [_stream(rows.drop_columns(whole)).to_pybytes()], **row}))
    return raw.size.to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> pa.Table:
    raw = pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd")
    row = pa.ipc.open_stream(raw).read_all()
    rest, schema = pa.ipc.open_stream(row["_rest"][0].as_buffer()).read_all(), pa.ipc.read_schema(pa.BufferReader(row["_schema"][0].as_buffer()))
    return pa.table([pa.array(_integers(row[f.name][0].as_py())).cast(f.type) if f.name in row.column_names else rest[f.name] for f in schema], schema=schema)


def _stream(rows: pa.Table) -> pa.Buffer:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as stream:
        stream.write_table(rows)
    return sink.getvalue()


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by their shard, packed: one row per shard and ``PACKED_ROWS`` rows of a task."""
    held: list[pa.RecordBatch] = []

    def close() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        held.clear()
        shard = rows["shard"].to_numpy()
        order = np.argsort(shard, kind="stable")
        rows = rows.drop_columns("shard").take(pa.array(order))
        used, starts = np.unique(shard[order], return_index=True)
        packed = [_pack(rows.slice(first, stop - first)) for first, stop in zip(starts, np.append(starts[1:], len(shard)))]
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(packed, pa.binary())], ["shard", "packed"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= PACKED_ROWS:
            yield close()
    if held:
        yield close()


class _VerdictCounts(StatefulProcessor):
    """Counts the verdicts of a shard as they come in. State are the verdicts that
    came, packed, a chunk per micro-batch; ``ALIKE`` chunks of about one size become
    one, and a chunk that the watermark has passed goes when the shard is met again."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "number int", "packed binary, size bigint, latest bigint, mark bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        came = pa.concat_tables([_unpack(bytes(packed)) for chunk in rows for packed in chunk["packed"]])
        late = came["at_us"].to_numpy() <= mark
        fresh = came.select([*VERDICT, "at_us"]).filter(pa.array(~late))
        seen = self._seen()
        both = pa.concat_tables([*(kept for kept, _ in seen.values()), fresh])
        places = both.append_column("place", pa.array(np.arange(len(both)))).group_by(VERDICT, use_threads=False).aggregate([("place", "min")])["place_min"]
        once = np.zeros(len(both), bool)
        once[places.to_numpy()] = True
        once = once[len(both) - len(fresh):]
        # A verdict without a time is never late, and known within its micro-batch only.
        self._keep(seen, fresh.filter(pa.array(once & (fresh["at_us"].to_numpy() < NO_TIME))), mark)
        first = np.zeros(len(came), bool)
        first[~late] = once
        counts = {"evaluated": first, "passed": first & came["passed"].to_numpy(), "resent": ~late & ~first, "late": late}
        table = pa.table({"check": came["check"].cast(pa.string()), **{c: pa.array(n.astype(np.int64)) for c, n in counts.items()}})
        yield table.group_by("check", use_threads=False).aggregate([(c, "sum") for c in counts]).select(["check", *[f"{c}_sum" for c in counts]]).rename_columns(["check", *counts]).to_pandas()

    def _seen(self) -> dict[int, tuple[pa.Table, int]]:
        """Chunks by number: what the watermark had not passed when the last came, and
        the size as it is stored."""
        chunks = {number: tuple(chunk) for (number,), chunk in self.known.iterator()}
        mark, seen = max((chunk[3] for chunk in chunks.values()), default=0), {}
        for number, (packed, size, latest, _) in chunks.items():
            if latest > mark:
                kept = _unpack(bytes(packed))
                seen[number] = (kept.filter(pa.array(kept["at_us"].to_numpy() > mark)), size)
            else:
                self.known.removeKey((number,))
        return seen

    def _keep(self, seen: dict[int, tuple[pa.Table, int]], new: pa.Table, mark: int) -> None:
        if not len(new):
            return
        number, seen = max(seen, default=-1) + 1, dict(seen)
        while len(same := [n for n, (_, size) in seen.items() if size.bit_length() // 3 == len(new).bit_length() // 3]) >= ALIKE - 1:
            new = pa.concat_tables([*(seen.pop(n)[0] for n in same), new])
            for n in same:
                self.known.removeKey((n,))
        self.known.updateValue((number,), (_pack(new), len(new), int(new["at_us"].to_numpy().max()), mark))

    def close(self) -> None:
        pass


def stream_pass_rate(evaluations: DataFrame, wait_seconds: int = 86400, delay: str = "1 minute", shards: int = 512) -> DataFrame:
    """Verdicts per check as they land, handed out as counts (`feeds.summed` adds
    them up): ``evaluated`` and ``passed`` of verdicts that came for the first
    time, ``resent`` repeats, ``late`` those that come when the watermark has
    passed them by ``wait_seconds``. A verdict is (check_id, rollout_id, eval_seq).

    Verdicts are shuffled once, packed by column; the ``shards``, over which those of
    every check are spread, keep the verdicts of the waiting time in the same form. A
    task holds those of one shard and those of its micro-batch at once.
    """
    key = evaluations.schema["check_id"].dataType.simpleString()
    check = F.col("check_id") if key in PLAIN[:4] else F.col("check_id").cast("string")
    # The watermark stands behind the latest verdict by the delay and the waiting
    # time: what it has passed is late. Without a time a verdict is never late.
    sent = evaluations.withWatermark("at", f"{delay} {int(wait_seconds)} seconds")
    rows = sent.select(F.pmod(F.xxhash64("check_id", "rollout_id", "eval_seq"), F.lit(shards)).alias("shard"), check.alias("check"),
                       _comparable(evaluations, "rollout_id").alias("rollout"), _comparable(evaluations, "eval_seq").alias("seq"),
                       F.coalesce("passed", F.lit(False)).alias("passed"), F.coalesce(F.unix_micros("at"), F.lit(NO_TIME)).alias("at_us"))
    counts = rows.mapInArrow(_dealt, "shard bigint, packed binary").groupBy("shard").transformWithStateInPandas(
        _VerdictCounts(), "check string, evaluated bigint, passed bigint, resent bigint, late bigint", outputMode="Append", timeMode="EventTime")
    return counts.select(F.col("check").cast(key).alias("check_id"), "evaluated", "passed", "resent", "late")
