"""Processors and folds that get the rows of many keys in one call, against one row after the other."""

from __future__ import annotations

import random

import pandas as pd

from rillflow.streaming import processors as P


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def clear(self):
        self.value = None


class Map:
    def __init__(self):
        self.rows, self.calls = {}, []

    def exists(self):
        return bool(self.rows)

    def containsKey(self, k):
        self.calls.append(k)
        return k in self.rows

    def getValue(self, k):
        return self.rows[k]

    def updateValue(self, k, v):
        self.calls.append(k)
        self.rows[k] = v

    def removeKey(self, k):
        del self.rows[k]

    def iterator(self):
        return iter(list(self.rows.items()))

    def clear(self):
        self.rows.clear()


class Handle:
    def __init__(self):
        self.timers = set()

    def getMapState(self, *a):
        return Map()

    def getValueState(self, *a):
        return Value()

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


def started(processor):
    processor.init(Handle())
    return processor


def call(processor, rows, columns):
    """One call with the rows in any order and in two frames; the rows it gives."""
    frame = pd.DataFrame(rows, columns=columns).sample(frac=1, random_state=3)
    parts = [x for x in (frame.iloc[:len(frame) // 2], frame.iloc[len(frame) // 2:]) if len(x)]
    return [r for out in processor.handleInputRows((0,), iter(parts), None) for r in out.to_dict("records")]


def batches_of(r, make, many=60):
    """Rows of several keys in a few batches, in the order of arrival."""
    seq = 0
    for size in (1, many, 3, many):
        batch = []
        for _ in range(size):
            batch.append(make(r.choice(["a", "b", "c", "d", "e"]), seq))
            seq += 1
        yield batch


def test_group_deltas_of_many_keys():
    r = random.Random(5)
    for _ in range(30):
        p, now = started(P.GroupDeltas("string")), {}
        for batch in batches_of(r, lambda k, s: (k, s, r.choice(["red", "blue", None]))):
            want = []
            for k, s, v in batch:
                old = now.get(k)
                if old != v:
                    want += [(k, s, old, -1)] * (old is not None) + [(k, s, v, 1)] * (v is not None)
                now[k] = v
            got = [(x["key"], x["seq"], x["group"], x["delta"]) for x in call(p, batch, ["key", "seq", "value"])]
            assert sorted(got) == sorted(want)
            assert p.current.rows == {(k,): (v,) for k, v in now.items() if v is not None}


def test_a_batch_touches_the_state_of_its_own_keys_only():
    p = started(P.GroupDeltas("bigint"))
    call(p, [(k, k, "red") for k in range(50)], ["key", "seq", "value"])
    p.current.calls.clear()
    call(p, [(7, 50, "blue"), (9, 51, "red")], ["key", "seq", "value"])
    assert set(p.current.calls) == {(7,), (9,)} and len(p.current.rows) == 50


def test_table_join_of_many_keys():
    r = random.Random(6)
    for _ in range(30):
        p, sides, sent = started(P.TableJoin("string", lambda a, b: a + b)), {}, {}
        for batch in batches_of(r, lambda k, s: (k, r.randrange(2), pd.Timestamp(s, unit="s"), s, r.choice(["x", "y", None]))):
            want = []
            for k, side, _, s, v in batch:
                pair = sides.setdefault(k, [None, None])
                pair[side] = v
                both = None not in pair
                if both or sent.get(k):
                    want.append((s, k, pair[0] + pair[1] if both else None, not both))
                sent[k] = both
            got = [(x["seq"], x["key"], x["value"], x["deleted"]) for x in call(p, batch, ["key", "side", "ts", "seq", "value"])]
            assert sorted(got) == want
            assert p.sides.rows == {(k,): (*v, None not in v) for k, v in sides.items() if v != [None, None]}


def test_asof_lookup_of_many_keys():
    r = random.Random(7)
    for _ in range(30):
        p, table = started(P.AsOfLookup("string")), {}
        for batch in batches_of(r, lambda k, s: (k, r.randrange(2), s, r.choice(["x", "y", None]), f"p{s}")):
            want = []
            for k, side, s, info, payload in batch:
                if side == 0:
                    table[k] = info
                else:
                    want.append((s, k, payload, table.get(k)))
            got = [(x["seq"], x["key"], x["payload"], x["info"]) for x in call(p, batch, ["key", "side", "seq", "info", "payload"])]
            assert sorted(got) == want
            assert p.info.rows == {(k,): (v,) for k, v in table.items() if v is not None}


def test_live_sessions_of_many_keys():
    """Versions and deletes of late and early rows; sessions past the watermark leave, one timer for all."""
    r, gap = random.Random(8), 10_000_000
    for _ in range(30):
        p, open_, at = started(P.LiveSessionsOfBucket("string", 10)), {}, 0
        for batch in batches_of(r, lambda k, s: (k, r.randrange(0, 400) * 1_000_000, s)):
            batch = [(k, t + at, s) for k, t, s in batch]
            rows, want = sorted(batch, key=lambda x: (x[0], x[1], x[2])), []
            for k, t, s in rows:
                mine = open_.setdefault(k, [])
                near = [x for x in mine if x[0] - gap <= t <= x[1] + gap]
                new = (min([t, *(x[0] for x in near)]), max([t, *(x[1] for x in near)]), 1 + sum(x[2] for x in near))
                want += [(s, k, *x, True) for x in near] + [(s, k, *new, False)]
                open_[k] = [x for x in mine if x not in near] + [new]
            frame = [(k, pd.Timestamp(t, unit="us"), t, s) for k, t, s in batch]
            got = [(x["seq"], x["key"], x["start_us"], x["end_us"], x["count"], x["deleted"])
                   for x in call(p, frame, ["key", "ts", "t_us", "seq"])]
            assert sorted(got) == sorted(want)
            at += 150_000_000
            (due,) = p.handle.timers
            if due <= at // 1000:  # the watermark passes it
                class Now:
                    getCurrentWatermarkInMs = lambda self: at // 1000
                p.handle.timers.clear()
                assert list(p.handleExpiredTimer((0,), Now(), None)) == []
                open_ = {k: [x for x in v if x[1] + gap > at] for k, v in open_.items()}
            held = {k[0]: [tuple(x) for x in p._sessions(v[0]).tolist()] for k, v in p.open.rows.items()}
            assert held == {k: sorted(v) for k, v in open_.items() if v}
            assert len(p.handle.timers) == (1 if held else 0)
            if held:
                assert min(p.handle.timers) <= min(x[1] for v in held.values() for x in v) // 1000 + 10_000


def test_fold_of_records_makes_no_frame_per_key(monkeypatch):
    from rillflow.operators.folds import of_records
    fold = of_records(init=lambda: (0, []), step=lambda s, r: (s[0] + (r[0] or 0), [*s[1], r[0]]), merge=lambda a, b: (a[0] + b[0], [*a[1], *b[1]]),
                      finish=lambda s: (s[0],), columns=["n"], state="total bigint, all array<bigint>", result="total bigint")
    rows = pd.DataFrame({"k": [i % 500 for i in range(2000)], "g": ["x", "y"] * 1000, "n": [None if i % 7 == 0 else i for i in range(2000)]})
    made = []
    plain = pd.Series.astype
    monkeypatch.setattr(pd.Series, "astype", lambda self, *a, **k: made.append(1) or plain(self, *a, **k))
    got = fold.step(rows, ["k", "g"])
    twice = fold.merge(pd.concat([got, got.iloc[::-1]], ignore_index=True), ["k", "g"])
    assert len(made) < 20
    monkeypatch.undo()
    for out, times in ((got, 1), (twice, 2)):
        assert list(out.columns) == ["k", "g", "total", "all"] and len(out) == 500
        for k, g, total, every in out.itertuples(index=False):
            mine = [None if i % 7 == 0 else i for i in range(k, 2000, 500)]
            assert g == "xy"[k % 2] and list(every) == mine * times and total == sum(x or 0 for x in mine) * times
