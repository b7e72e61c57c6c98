"""Keyed stream state: duplicates, quiet spans, restarts and replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from retentio.streaming.activity import EVENT, QUIET, quiet_users_job

DAY = 86_400_000
SCHEMA = "event_id long, user_id long, ts timestamp"


def events(n=120, seed=3):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=4 * k, minutes=rng.randrange(60))
        out.append((k, rng.choice([1, 1, 1, 2, 3, None]) if k % 40 < 25 else 1, at))
    out += [(1000, 2, None), (1001, None, None)]
    return out


def expected(rows, quiet, delay=DAY):
    ids = {r[0]: r for r in rows}.values()
    ms = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    last = max(ms(t) for _, _, t in rows if t) - delay
    quiet_rows = set()
    for u in {u for _, u, _ in ids}:
        times = sorted({ms(t) for _, v, t in ids if v == u and t})
        for a, b in zip(times, [*times[1:], None]):
            if (b is None or b > a + quiet) and a + quiet <= last:
                quiet_rows.add((u, a + quiet))
    return {(u, i) for i, u, _ in ids}, quiet_rows


def found(df):
    rows = df.withColumn("ms", F.unix_millis("at")).collect()
    seen, quiet = [(r.user_id, int(r.event_id)) for r in rows if r.kind == EVENT], [(r.user_id, r.ms) for r in rows if r.kind == QUIET]
    assert len(seen) == len(set(seen)) and len(quiet) == len(set(quiet))
    return set(seen), set(quiet)


@pytest.mark.parametrize("files", [1, 4])
def test_batches_restarts_and_duplicates_have_no_bearing(spark, tmp_path, files):
    """All at once, or in files of which some come later and repeat earlier events, with a restart between."""
    rows, quiet = events(), 2 * DAY
    src, work = str(tmp_path / "in"), str(tmp_path / "work")
    size = -(-len(rows) // files)
    for k in range(files):
        part = rows[k * size:(k + 1) * size] + (rows[k * size - 3:k * size] + rows[-2:] if k else [])
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        got = quiet_users_job(spark, src, quiet, work_dir=work, max_files=1, schema=spark.read.parquet(src).schema)
    want = expected(rows, quiet)
    assert found(got) == want and len(want[1]) > 3
    again = quiet_users_job(spark, src, quiet, work_dir=work, schema=spark.read.parquet(src).schema)
    assert found(again) == want


class Held:
    """State of one user in memory, counting the calls to it."""

    def __init__(self, calls=None):
        self.calls, self.timers, self.items, self.map = [] if calls is None else calls, set(), [], {}

    def __getattr__(self, name):
        def call(*a):
            self.calls.append(name)
            return getattr(self, f"do_{name}")(*a)
        return call

    def do_getListState(self, *a): return Held(self.calls)
    def do_getMapState(self, *a): return Held(self.calls)
    def do_registerTimer(self, at): self.timers.add(at)
    def do_get(self): return iter(list(self.items))
    def do_put(self, rows): self.items = list(rows)
    def do_appendList(self, rows): self.items += rows
    def do_clear(self): self.items = []
    def do_exists(self): return bool(self.map)
    def do_containsKey(self, key): return key in self.map
    def do_updateValue(self, key, value): self.map[key] = value
    def do_getValue(self, key): return self.map[key]
    def do_removeKey(self, key): del self.map[key]
    def do_keys(self): return iter(list(self.map))


def test_state_calls_do_not_grow_with_a_users_events(monkeypatch):
    """Every call is a round trip: a batch takes a few, however many events a user has."""
    from types import SimpleNamespace as N

    from retentio.streaming import activity
    monkeypatch.setattr(activity, "CHUNK", 100, raising=False)
    held, quiet = Held(), 2 * DAY
    user = activity.QuietUsers(quiet)
    user.init(held)
    rng = random.Random(5)
    times = [rng.randrange(6000) * DAY // 4 + rng.randrange(3) for _ in range(1200)]
    now = N(getCurrentWatermarkInMs=lambda: 0)
    for half in (times[:700], times[600:]):
        list(user.handleInputRows((1,), iter([N(event_id=t, at_ms=t) for t in half]), now))
    end, got = 1000 * DAY, set()
    late = N(getCurrentWatermarkInMs=lambda: end)
    while held.timers and min(held.timers) <= end:
        at = min(held.timers)
        held.timers.discard(at)
        rows = [r.at_ms for r in user.handleExpiredTimer((1,), late, N(getExpiryTimeInMs=lambda at=at: at))]
        assert not got & set(rows)
        got |= set(rows)
    every = sorted(set(times))
    want = {a + quiet for a, b in zip(every, [*every[1:], None]) if (b is None or b > a + quiet) and a + quiet <= end}
    assert got == want and want
    assert len(held.calls) < 40
    assert min(at for chunk, _ in user.open.items for at in chunk) + quiet > end
