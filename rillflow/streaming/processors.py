"""Stateful processors for ``groupBy(key).transformWithStateInPandas``.

Each processor keeps small per-key state in Spark's state store (RocksDB provider,
checkpointed) and is driven per micro-batch with the rows of one key. Rows of a key
inside a micro-batch come in no particular order, so each processor sorts them first, by
``seq``, the offset: tables, as-of lookups and running state follow the order of arrival,
whatever the rows' event times, so the result does not depend on how the input is cut into
micro-batches. Event time counts only for windows, sessions and held output.

A call of a processor costs milliseconds, whatever it is given. So the processors of tables,
groups, lookups and live sessions are called per bucket of keys (:data:`BUCKETS`): they work
on the rows of many keys at once, and keep the state of each key apart, in a map, so a batch
reads and writes the state of its own keys only.

A processor sees all rows of its key, or of its bucket, in a micro-batch at once; cap the
source's rate (``maxOffsetsPerTrigger``, ``max_files_per_trigger``) to bound them.

The same processors run on a batch DataFrame too (one pass, empty state).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)
from pyspark import cloudpickle
from pyspark.sql import types as T


# Ship these classes to the Python workers inside the job itself (pickled by value),
# so they run even where the package is not installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Buckets of keys; a call of a processor gets the rows of one.
BUCKETS = 1024


def _carry(is_change: np.ndarray, values: pd.Series, of: np.ndarray, starts: list):
    """The value current after each row: a change row sets it (null = deleted), other rows keep
    the last one of their key; ``starts`` are the keys' values before the batch."""
    heads, own = _ends(of)[0] + np.arange(len(starts)), np.arange(len(of)) + of + 1
    pool = np.empty(len(values) + len(starts), dtype=object)  # each key's start, then its rows
    pool[heads] = starts
    pool[own] = values.astype(object).where(values.notna(), None)
    return pool[np.maximum.accumulate(np.where(is_change, own, heads[of]))]


def _ends(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last row of each key; ``of`` says whose each row is, key after key."""
    heads = np.flatnonzero(np.diff(of, prepend=-1))
    return heads, np.append(heads[1:], len(of)) - 1


def _rows(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    pdf = pd.concat(list(batches), ignore_index=True)
    return pdf.sort_values(order, kind="stable", ignore_index=True)


def _rows_by_key(batches: Iterator[pd.DataFrame], order: list[str]) -> tuple[pd.DataFrame, np.ndarray, list[tuple]]:
    """The rows of a bucket, key after key, each key's in ``order``; whose each row is, by number; the
    keys as a map state takes them."""
    pdf = pd.concat(list(batches), ignore_index=True)
    of, keys = pd.factorize(pdf["key"])
    pdf = pdf.assign(__of=of).sort_values(["__of", *order], kind="stable", ignore_index=True)
    return pdf, pdf["__of"].to_numpy(), [(k,) for k in pd.Series(keys).astype(object)]


def _held(state, keys: list[tuple], nothing: tuple) -> list[tuple]:
    """What a map state holds of the keys; ``nothing`` for a key that is not in it."""
    if not state.exists():
        return [nothing] * len(keys)
    return [tuple(state.getValue(k)) if state.containsKey(k) else nothing for k in keys]


def _hold(state, keys: list[tuple], before: list[tuple], now: list[tuple], nothing: tuple) -> None:
    """Puts what changed into a map state; a key with ``nothing`` leaves it."""
    for k, b, n in zip(keys, before, now):
        if n == nothing:
            if b != nothing:
                state.removeKey(k)
        elif n != b:
            state.updateValue(k, n)


# ---------------------------------------------------------------- running balance
RUNNING_OUT = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()), T.StructField("cents", T.LongType()),
    T.StructField("running_cents", T.LongType()),
])  # cents: whole numbers, so that the sums are exact


class RunningBalance(StatefulProcessor):
    """Per key: balance = stored balance (or 0) + amount, for each row in order; emits
    every row with its running balance. Input ``key, seq, ts, cents``; amounts are whole
    cents so the sums are exact."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.balance = handle.getValueState("balance", "cents long")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, ["seq"])
        start = int(self.balance.get()[0]) if self.balance.exists() else 0
        cents = pd.array(pdf["cents"], dtype="Int64").fillna(0).astype("int64")  # a null amount adds nothing
        pdf["running_cents"] = cents.cumsum() + start
        self.balance.update((int(pdf["running_cents"].iloc[-1]),))
        yield pdf[["key", "seq", "ts", "cents", "running_cents"]]

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- table x table join
TABLE_JOIN_OUT = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()), T.StructField("value", T.StringType()),
    T.StructField("deleted", T.BooleanType()),
])


class TableJoin(StatefulProcessor):
    """Inner join of two tables given as one tagged changelog ``key, side (0 left,
    1 right), ts, seq, value`` (null value = delete). State holds both sides' current
    values, and nothing once both are gone. Each change re-emits the joined value when
    both sides are present, and a delete when the pair was emitted before but one side
    is now gone. ``joiner`` makes the joined value from the arrays of left and right values;
    the right side's value by default. The rows are of a bucket of keys; ``key_type`` is theirs."""

    def __init__(self, key_type: str, joiner=None) -> None:
        self.key_type = key_type
        self.joiner = joiner or (lambda left, right: right)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sides = handle.getMapState(
            "sides", f"key {self.key_type}", "left string, right string, emitted boolean")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf, of, keys = _rows_by_key(rows, ["seq", "side"])
        heads, tails = _ends(of)
        nothing = (None, None, False)
        held = _held(self.sides, keys, nothing)
        lv = _carry((pdf["side"] == 0).to_numpy(), pdf["value"], of, [h[0] for h in held])
        rv = _carry((pdf["side"] == 1).to_numpy(), pdf["value"], of, [h[1] for h in held])
        both = pd.notna(lv) & pd.notna(rv)
        before = np.concatenate([[False], both[:-1]])
        before[heads] = [h[2] for h in held]
        send = both | before  # a joined value, or a delete after an emitted pair
        _hold(self.sides, keys, held, list(zip(lv[tails], rv[tails], both[tails].tolist())), nothing)
        if send.any():
            value = np.full(len(pdf), None, dtype=object)
            value[both] = self.joiner(lv[both], rv[both])
            yield pd.DataFrame({"key": pdf["key"].values[send], "ts": pdf["ts"].values[send],
                                "seq": pdf["seq"].values[send], "value": value[send],
                                "deleted": ~both[send]})

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- re-grouped count deltas
DELTA_OUT = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("group", T.StringType()), T.StructField("delta", T.LongType()),
])


class GroupDeltas(StatefulProcessor):
    """Per key, its current group (e.g. a user's colour); each change emits -1 for the
    old group and +1 for the new one (a delete only -1). Summing the deltas per group
    gives the count of keys currently in it, groups at zero included: the retraction a
    table re-group needs, without holding the table anywhere but in keyed state.
    Input ``key, ts, seq, value`` of a bucket of keys; ``key_type`` is theirs."""

    def __init__(self, key_type: str) -> None:
        self.key_type = key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getMapState("current", f"key {self.key_type}", "grp string")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf, of, keys = _rows_by_key(rows, ["seq"])
        heads, tails = _ends(of)
        before = _held(self.current, keys, (None,))
        vals = pdf["value"].astype(object).where(pdf["value"].notna(), None).to_numpy()
        prev = np.empty(len(vals), dtype=object)
        prev[1:] = vals[:-1]
        prev[heads] = [b[0] for b in before]
        codes = pd.factorize(np.concatenate([vals, prev]))[0]
        changed = codes[:len(vals)] != codes[len(vals):]
        ch = pdf.loc[changed, ["key", "seq", "__of"]].assign(old=prev[changed], new=vals[changed])
        minus = ch[ch["old"].notna()].assign(group=lambda d: d["old"], delta=-1)
        plus = ch[ch["new"].notna()].assign(group=lambda d: d["new"], delta=1)
        out = pd.concat([minus, plus], ignore_index=True)
        _hold(self.current, keys, before, [(v,) for v in vals[tails]], (None,))
        if len(out):
            yield out.sort_values(["__of", "seq", "delta"], kind="stable")[DELTA_OUT.fieldNames()]

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- as-of lookup
ASOF_OUT = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("payload", T.StringType()), T.StructField("info", T.StringType()),
])


class AsOfLookup(StatefulProcessor):
    """Stream rows see the table as it is when they arrive. Input is one tagged stream
    ``key, side (0 table change, 1 stream row), ts, seq, info, payload``; state is the
    key's current table value. Table changes update it (null info deletes); stream rows
    are emitted with the current value (null when none: the left-join form). The rows are of
    a bucket of keys; ``key_type`` is theirs."""

    def __init__(self, key_type: str) -> None:
        self.key_type = key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.info = handle.getMapState("info", f"key {self.key_type}", "info string")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf, of, keys = _rows_by_key(rows, ["seq", "side"])
        held = _held(self.info, keys, (None,))
        table_rows = (pdf["side"] == 0).to_numpy()
        filled = _carry(table_rows, pdf["info"], of, [h[0] for h in held])
        _hold(self.info, keys, held, [(v,) for v in filled[_ends(of)[1]]], (None,))
        rows_out = ~table_rows
        if rows_out.any():
            yield pd.DataFrame({"key": pdf["key"].values[rows_out], "seq": pdf["seq"].values[rows_out],
                                "payload": pdf["payload"].values[rows_out],
                                "info": filled[rows_out]})

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- time-limited emission
SUPPRESS_OUT = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("value", T.StringType()),
    T.StructField("deleted", T.BooleanType()), T.StructField("seq", T.LongType()),
])


class HoldNewest(StatefulProcessor):
    """Rate-limited table output, by event time alone. A hold of a key opens at its first row,
    at time t; the newest row before t + ``limit_ms`` is emitted, and the next row from then on
    opens the next hold. A hold is settled once the watermark passes its end, when all rows
    that count have arrived, so what is emitted does not depend on how the input is cut into
    micro-batches: updates at 0, 30, 70, 200 and 400 s with a limit of 60 s give those at 30,
    70, 200 and 400 s.

    Rows that wait for the watermark are held in state: of each hold that is full, only what
    later rows could still change. ``max_bytes`` bounds them per key: beyond it all holds but
    the last are settled early, as the rows held so far say. Input ``key, ts, t_ms, seq,
    value`` (null value = delete; ``t_ms`` is the event time in epoch milliseconds, computed in
    Spark so it does not depend on the session time zone)."""

    def __init__(self, limit_ms: int, max_bytes: int = 100_000) -> None:
        self.limit_ms = int(limit_ms)
        self.max_bytes = int(max_bytes)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "t long, seq long, value string")
        self.open = handle.getValueState("open", "start long, timer long")

    def _settle(self, key, pdf: pd.DataFrame, start: int, upto: int):
        """Emits the holds that end by ``upto``; (their rows, the rest, its start)."""
        t = pdf["t"].to_numpy()
        out, a = [], 0
        while a < len(t):
            start = int(t[a]) if start < 0 else start
            due = start + self.limit_ms
            b = int(np.searchsorted(t, due))
            if due > upto:
                break
            out.append(b - 1)
            a, start = b, -1
        done = pdf.iloc[out]
        rows = pd.DataFrame({"key": key[0], "value": done["value"].to_numpy(), "deleted": done["value"].isna().to_numpy(),
                             "seq": done["seq"].to_numpy()}, columns=SUPPRESS_OUT.fieldNames())
        return rows, pdf.iloc[a:], start

    def _go(self, key, pdf: pd.DataFrame, watermark: int) -> Iterator[pd.DataFrame]:
        start, timer = self.open.get() if self.open.exists() else (-1, -1)
        if start >= 0 and len(pdf) and int(pdf["t"].iloc[0]) < start:
            start = int(pdf["t"].iloc[0])  # an earlier row came later: the hold began with it
        out, rest, start = self._settle(key, pdf, start, watermark)
        size = 16 * len(rest) + int(rest["value"].astype("string").str.len().fillna(0).sum())
        if size > self.max_bytes:
            early, rest, start = self._settle(key, rest, start, int(rest["t"].iloc[-1]))
            out = pd.concat([out, early], ignore_index=True)
        if len(rest):
            # once no earlier row can come the hold's end is fixed, and of the rows before it
            # only the newest counts
            inside = int(np.searchsorted(rest["t"].to_numpy(), start + self.limit_ms))
            rest = rest.iloc[max(0, inside - 1) if start <= watermark else 0:]
            self.held.put([(int(t), int(s), None if v is None or v != v else v)
                           for t, s, v in zip(rest["t"], rest["seq"], rest["value"])])
            due = start + self.limit_ms
            if due != timer:
                if timer >= 0 and timer > watermark:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
            self.open.update((start, due))
        else:
            self.held.clear()
            self.open.clear()
        if len(out):
            yield out

    def _held(self) -> pd.DataFrame:
        rows = list(self.held.get()) if self.held.exists() else []
        return pd.DataFrame(rows, columns=["t", "seq", "value"])

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)[["t_ms", "seq", "value"]].set_axis(["t", "seq", "value"], axis=1)
        held = self._held()
        pdf = pd.concat([held, new], ignore_index=True) if len(held) else new
        pdf = pdf.sort_values(["t", "seq"], kind="stable", ignore_index=True)
        yield from self._go(key, pdf, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._go(key, self._held(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- live sessions
LIVE_SESSION_OUT = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("start_us", T.LongType()),
    T.StructField("end_us", T.LongType()), T.StructField("count", T.LongType()),
    T.StructField("deleted", T.BooleanType()), T.StructField("seq", T.LongType()),
])


def _session_versions(pdf: pd.DataFrame, of: np.ndarray, old: np.ndarray, whose: np.ndarray, gap_us: int):
    """What rows make of the sessions of their keys: every new version and every delete, then the
    sessions that are open afterwards (start, end, count) and whose they are.

    ``pdf`` has the rows key after key, each key's by time; ``of`` says whose each row is. ``old`` are
    the sessions open before, in the same order, and ``whose`` they are."""
    t, seq, key = pdf["t_us"].to_numpy(dtype=np.int64), pdf["seq"].to_numpy(dtype=np.int64), pdf["key"].to_numpy()
    lo, hi = _ends(of)
    # open sessions are more than a gap apart; each one is met by the first row within a gap of it
    at = np.array([lo[k] + np.searchsorted(t[lo[k]:hi[k] + 1], s - gap_us) for k, s in zip(whose, old[:, 0])], np.int64)
    met = at <= hi[whose]
    met[met] = t[at[met]] <= old[met, 1] + gap_us
    first, last, n = t.copy(), t.copy(), np.ones(len(t), np.int64)  # of each row and the sessions it meets
    np.minimum.at(first, at[met], old[met, 0])
    np.maximum.at(last, at[met], old[met, 1])
    np.add.at(n, at[met], old[met, 2])
    # the session's versions: its end so far, and where a row begins another session
    end = pd.Series(last).groupby(of).cummax().to_numpy()
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] - end[:-1] > gap_us) | (of[1:] != of[:-1])
    heads = np.flatnonzero(new)
    session = np.cumsum(new) - 1
    start = first[heads][session]
    upto = np.cumsum(n)
    count = upto - (upto - n)[heads][session]
    goes_on = np.flatnonzero(~new)  # such a row replaces the version before it
    parts = [(key[at[met]], old[met, 0], old[met, 1], old[met, 2], True, seq[at[met]]),
             (key[goes_on], start[goes_on], end[goes_on - 1], count[goes_on - 1], True, seq[goes_on]),
             (key, start, end, count, False, seq)]
    names = LIVE_SESSION_OUT.fieldNames()
    out = pd.concat([pd.DataFrame(dict(zip(names, x))) for x in parts if len(x[0])], ignore_index=True)
    tails = np.append(heads[1:], len(t)) - 1
    sessions = np.concatenate([old[~met], np.stack([start, end, count], axis=1)[tails]])
    owner = np.concatenate([whose[~met], of[tails]])
    order = np.lexsort((sessions[:, 0], owner))
    return out, sessions[order], owner[order]


class LiveSessions(StatefulProcessor):
    """Session counts with every update emitted (not only final ones). A row within
    ``gap`` of one or more open sessions of its key (both ends inclusive) merges them;
    the merged session is emitted with its new bounds and count, and each session it
    replaced is emitted as a delete. Sessions leave state once the watermark passes
    their end + gap (one event-time timer per key, at the earliest expiry). Input
    ``key, ts, t_us, seq`` (``t_us``: event time in epoch microseconds, computed in
    Spark); output times are epoch microseconds; ``seq`` orders the emitted changes."""

    def __init__(self, gap_seconds: int) -> None:
        self.gap_us = int(gap_seconds) * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start_us long, end_us long, n long")
        self.due = handle.getValueState("due", "ms long")

    def _arm(self, ends: np.ndarray) -> None:
        """Keep one timer, at the earliest expiry (first end + gap): when it fires, every
        expired session goes at once and the timer moves on."""
        if not len(ends):
            self.due.clear()
            return
        want = (int(ends.min()) + self.gap_us) // 1000
        have = self.due.get()[0] if self.due.exists() else None
        if have is None or want < have:
            if have is not None:
                self.handle.deleteTimer(have)
            self.handle.registerTimer(want)
            self.due.update((want,))

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, ["ts", "seq"])
        old = np.array(sorted(tuple(s) for s in self.open.get()) if self.open.exists() else [], np.int64).reshape(-1, 3)
        out, sessions, _ = _session_versions(pdf, np.zeros(len(pdf), np.int64), old, np.zeros(len(old), np.int64), self.gap_us)
        self._arm(sessions[:, 1])
        self.open.put([tuple(x) for x in sessions.tolist()])
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        if self.open.exists():
            left = [tuple(s) for s in self.open.get() if s[1] + self.gap_us > wm_us]
            if left:
                self.open.put(left)
            else:
                self.open.clear()
            self._arm(np.array([s[1] for s in left], np.int64))
        return iter([])

    def close(self) -> None:
        pass


class LiveSessionsOfBucket(LiveSessions):
    """The live sessions of a bucket of keys; ``key_type`` is theirs. A key's open sessions are one entry
    of a map: whole numbers of 8 bytes, little-endian, start, end and count of each. One timer
    serves the bucket, at its earliest expiry."""

    def __init__(self, key_type: str, gap_seconds: int) -> None:
        super().__init__(gap_seconds)
        self.key_type = key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", f"key {self.key_type}", "sessions binary")
        self.due = handle.getValueState("due", "ms long")

    @staticmethod
    def _sessions(held: bytes) -> np.ndarray:
        return np.frombuffer(held, "<i8").reshape(-1, 3)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf, of, keys = _rows_by_key(rows, ["ts", "seq"])
        before = _held(self.open, keys, (b"",))
        old = [self._sessions(h[0]) for h in before]
        whose = np.repeat(np.arange(len(keys)), [len(o) for o in old])
        out, sessions, owner = _session_versions(pdf, of, np.concatenate(old), whose, self.gap_us)
        self._arm(sessions[:, 1])
        cuts = np.searchsorted(owner, np.arange(len(keys) + 1))
        now = [(sessions[a:b].astype("<i8").tobytes(),) for a, b in zip(cuts[:-1], cuts[1:])]
        _hold(self.open, keys, before, now, (b"",))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        held = [(tuple(k), tuple(v)) for k, v in self.open.iterator()] if self.open.exists() else []
        left = []
        for _, v in held:
            sessions = self._sessions(v[0])
            left.append(sessions[sessions[:, 1] + self.gap_us > wm_us])
        if any(len(x) for x in left):
            keys, before = [k for k, _ in held], [v for _, v in held]
            _hold(self.open, keys, before, [(x.tobytes(),) for x in left], (b"",))
            self._arm(np.concatenate(left)[:, 1])
        else:
            self.open.clear()
        return iter([])
