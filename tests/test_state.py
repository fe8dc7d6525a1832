"""Keyed state on streams: several micro-batches, and a restart in between, give what one batch gives."""

import pytest

from weftline.streaming import ledger, state


@pytest.fixture
def parts(spark, sf_dir, tmp_path):
    """Writes the events in three files, one after another in time."""
    rows = sorted(spark.read.parquet(f"{sf_dir}/events.parquet").collect(), key=lambda r: (r.ts, r.event_id))
    frame = lambda a, b: spark.createDataFrame(rows[a:b], ledger.EVENTS).coalesce(1)
    third = len(rows) // 3
    folder = str(tmp_path / "in")
    made = [(0, third), (third, 2 * third), (2 * third, len(rows))]
    return folder, [lambda a=a, b=b: frame(a, b).write.mode("append").parquet(folder) for a, b in made]


def test_slots_go_on_after_a_restart(spark, sf_dir, parts, tmp_path):
    folder, write = parts
    out, where = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: state.run_slots(spark, folder, "*.parquet", ledger.EVENTS, out, where, 30_000_000, files=1)
    write[0]()
    run()
    write[1]()
    write[2]()
    run()
    want = {r.event_id: r.slot_us for r in ledger.slots(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_type", "ts", 30).collect()}
    assert {r.event_id: r.slot_us for r in spark.read.parquet(out).collect()} == want
    run()  # nothing new
    assert spark.read.parquet(out).count() == len(want)


def test_progress_goes_on_after_a_restart(spark, sf_dir, parts, tmp_path):
    folder, write = parts
    out, where = str(tmp_path / "out"), str(tmp_path / "state")
    for k in range(3):
        write[k]()
        state.run_progress(spark, folder, "*.parquet", ledger.EVENTS, out, where, files=1)
    rows = state.attempts(spark.read.parquet(f"{sf_dir}/events.parquet")).collect()
    end = max(r.us for r in rows) // 1000 * 1000
    found = {r.unit: r for r in state.latest(spark, out).collect()}
    waiting = 0
    for unit in {r.unit for r in rows}:
        mine = [r for r in rows if r.unit == unit]
        done = sorted({r["item"] for r in mine if r.ok})
        late = {r["item"] for r in mine if not r.ok and r["item"] not in done and r.us + state.WAIT_US > end}
        waiting += len(late)
        got = found[unit]
        assert got.completed == ",".join(map(str, done)) and got.n_retry == len(late) and got.attempts == len(mine)
        assert got.used == pytest.approx(sum(r.used for r in mine if r.ok)) and got.failed == pytest.approx(sum(r.used for r in mine if not r.ok))


class Held(dict):
    """A state that counts its calls."""

    calls = 0

    def __getattr__(self, name):
        Held.calls += 1
        at = lambda k=(0,): super(Held, self).get(k)
        calls = {"getValue": at, "containsKey": self.__contains__, "updateValue": self.__setitem__, "removeKey": self.__delitem__, "iterator": lambda: iter(list(dict.items(self))), "values": lambda: iter(list(dict.values(self)))}
        return calls[name]

    def keys(self):
        return iter(list(dict.keys(self)))

    def get(self):
        Held.calls += 1
        return dict.get(self, (0,))

    def update(self, value):
        Held.calls += 1
        self[(0,)] = value


def test_state_is_called_by_chunks_and_timers_sweep_once(monkeypatch):
    """F32: each item was some calls, and each timer listed all of a unit's items."""
    from types import SimpleNamespace

    import pandas as pd

    states, timers = {}, set()
    made = lambda name, *_: states.setdefault(name, Held())
    handle = SimpleNamespace(getMapState=made, getValueState=made, registerTimer=timers.add)
    unit = state.Progress()
    unit.init(handle)
    n = 5000
    items = pd.Series(range(n)) * 50
    ok = pd.Series(range(n)) % 10 != 0
    Held.calls = 0
    first = list(unit.handleInputRows((0,), iter([pd.DataFrame({"item": items, "us": items * 1000, "ok": ok, "used": 1.0})]), None))[-1]
    assert first["n_completed"][0] == 4500 and first["n_retry"][0] == 500 and Held.calls < 1000
    late = [k for k in range(0, n, 10) if k % 20 == 0]
    again = pd.DataFrame({"item": [k * 50 for k in late] * 2, "us": [0, 10**9] * len(late), "ok": [True] * len(late) + [False] * len(late), "used": 2.0})
    found = list(unit.handleInputRows((0,), iter([again, again[:0]]), None))[-1]
    want = sorted(k * 50 for k in range(n) if k % 10 or k % 20 == 0)
    assert found["completed"][0] == ",".join(map(str, want)) and found["n_retry"][0] == 250 and found["attempts"][0] == n + len(again)
    assert found["used"][0] == 4500 + 2 * len(late) and found["failed"][0] == 500 + 2 * len(late)
    now = max(timers)
    wide = SimpleNamespace(getCurrentWatermarkInMs=lambda: now)
    fired = [r for at in sorted(timers) for r in unit.handleExpiredTimer((0,), wide, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))]
    assert len(fired) == 1 and fired[0]["n_retry"][0] == 0 and fired[0]["completed"][0] == found["completed"][0]
