"""Rows between barriers, widened spans and the streamed metric against plain versions."""

import random
from datetime import datetime, timedelta

import pytest

from docloom.operators import chains
from docloom.streaming import sliding

rng = random.Random(2)
BOX = "page_id long, area_id long, x1 double, y1 double, x2 double, y2 double"


def plain_rows(cells, lines, t):
    """Groups found by a walk from the first cell left."""

    def crossed(a, b):
        x1, y1, x2, y2 = min(a[2], b[2]), min(a[3], b[3]), max(a[4], b[4]), max(a[5], b[5])
        return any(x1 < u1 < x2 and y1 > v1 and y2 < v2 or y1 < v1 < y2 and x1 > u1 and x2 < u2 for _, _, u1, v1, u2, v2 in lines)

    left, out = sorted(cells, key=lambda c: c[1]), []
    while left:
        group, todo = [], [left.pop(0)]
        while todo:
            a = todo.pop()
            group.append(a)
            near = [b for b in left if a[3] <= b[5] - t and a[5] >= b[3] + t and not crossed(a, b)]
            left = [b for b in left if b not in near]
            todo += near
        out.append(group)
    out.sort(key=lambda g: (min(c[3] for c in g), min(c[1] for c in g)))
    return {(c[0], c[1]): (k, j, len(g)) for k, g in enumerate(out) for j, c in enumerate(sorted(g, key=lambda c: (c[2], c[1])))}


@pytest.mark.parametrize("tolerance,walks", [(0.0, 10), (4.0, 1)])
def test_row_chains(spark, tolerance, walks):
    cells, lines, want = [], [], {}
    for page in range(4):
        own = [(page, i, float(x := rng.randint(0, 400)), float(y := rng.randint(0, 300)), float(x + rng.randint(10, 60)), float(y + rng.randint(6, 14))) for i in range(45)]
        bars = [(page, 1000 + i, float(x := rng.randint(-80, 100)), float(y := rng.randint(0, 300)), float(x + rng.randint(200, 500)), float(y)) for i in range(12 * (page > 0))] + [(page, 2000, 200.0, -10.0, 200.0, 150.0)] * (page > 1)
        cells, lines = cells + own, lines + bars
        want |= plain_rows(own, bars, tolerance)
    bars = spark.createDataFrame(lines, BOX)
    got = chains.row_chains(spark.createDataFrame(cells, BOX), bars, tolerance, walks)
    assert {(r.page_id, r.area_id): (r.row_no, r.place, r.n) for r in got.collect()} == want
    free = chains.row_chains(spark.createDataFrame(cells, BOX), bars.limit(0), tolerance, walks).collect()
    assert len({(r.page_id, r.row_no) for r in free}) < len({(p, want[p, a][0]) for p, a, *_ in cells})
    assert chains.probable_width(got).count() == 4


def plain_widened(rows, stabs):
    m = [list(r) for r in rows]
    for a, b in ((0, 1), (0, 2), (1, 2)):
        for c in range(1, len(m[a]) - 1):
            if m[a][c] and not m[a][c - 1] and not m[a][c + 1] and all(m[b][c + k] for k in (-1, 0, 1)) and not any(int(m[b][c - 1][1]) <= s < int(m[b][c + 1][2]) for s in stabs):
                m[a][c - 1] = m[a][c + 1] = m[a][c]
    for c in range(len(m[0])):
        m[0][c] = m[0][c] or m[1][c]
        m[1][c] = m[1][c] or m[0][c]
    return m


def test_widened(spark):
    cells, lines, want, without = [], [], set(), set()
    for t in range(120):
        rows = [[(100 * r + c, 50.0 * c + 1, 50.0 * c + 45) if rng.random() < p else None for c in range(9)] for r, p in enumerate((0.4, 0.6, 0.9, 0.5))]
        stabs = [float(rng.randint(0, 450)) for _ in range(rng.randint(0, 3))]
        cells += [(t, r, c, *x) for r, row in enumerate(rows) for c, x in enumerate(row) if x]
        lines += [(t, s) for s in stabs]
        for out, s in ((want, stabs), (without, [])):
            out |= {(t, r, c, x[0]) for r, row in enumerate(plain_widened(rows, s)) for c, x in enumerate(row) if x}
    made = spark.createDataFrame(cells, "table_id long, r int, c long, cell_id long, x1 double, x2 double")
    assert {tuple(r) for r in chains.widened(made, spark.createDataFrame(lines, "table_id long, x1 double")).collect()} == want != without


def test_sliding_stream(spark, tmp_path):
    """Late, disordered and repeated events over a stop and a restart: the rows of the sorted table."""
    start = datetime(2024, 1, 1)
    events = [(i, start + timedelta(minutes=7 * i, seconds=rng.randint(0, 2000)), rng.choice([1, 1, 1, 2, None]), rng.choice([None, round(rng.random(), 2), 5.0])) for i in range(160)]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "event_id long, ts timestamp, user_id long, value double"
    put = lambda rows: spark.createDataFrame(rng.sample(rows, len(rows)), schema).coalesce(1).write.mode("append").parquet(source)
    put(events[:60])
    put(events[60:100] + events[50:60])
    sliding.run_sliding(spark, source, out, checkpoint)
    first = spark.read.schema(sliding.OUT).parquet(out).count()
    put(events[100:] + events[95:100])
    sliding.close_events(spark, source)
    sliding.run_sliding(spark, source, out, checkpoint)
    sliding.run_sliding(spark, source, out, checkpoint)
    got = {r.event_id: tuple(r) for r in spark.read.schema(sliding.OUT).parquet(out).where("event_id <> -1").collect()}
    assert 0 < first < len(events) == len(got) == spark.read.parquet(out).where("event_id <> -1").count()
    seen = {}
    for i, ts, user, value in sorted(events, key=lambda e: (e[1], e[0])):
        own = seen.setdefault(user, [])
        own.append(value)
        every = [v for v in own if v is not None]
        want = (user, i, *sliding.measures(own[-20:]), sum(every) / len(every) if every else None, min(20, len(own)))
        assert all(a == b or abs(a - b) < 1e-9 for a, b in zip(got[i], want)), (got[i], want)


def test_rows_are_found_where_their_page_is(spark, sf):
    """Cells and barriers are dealt by page once each; nothing is written between, and no join follows."""
    from docloom import catalogue

    plan = catalogue.queries()["row_chains"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_spans_are_widened_where_their_table_is(spark, sf):
    """Only lines are dealt, by table; cells and upright lines are neither exchanged nor sent to all tasks, whatever the files' size."""
    from docloom import catalogue

    plan = catalogue.queries()["widened_spans"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_NUM") == plan.count("FileScan") and "BroadcastExchange" not in plan


def test_a_user_waits_in_few_calls():
    """State is asked for by batch and by timer, not by event: calls don't grow with a user's events."""
    calls = []

    class State:
        def __init__(self):
            self.held = None

        def exists(self):
            calls.append("exists")
            return self.held is not None

        def get(self):
            calls.append("get")
            return iter(self.held or []) if isinstance(self.held, list) else self.held

        def update(self, value):
            calls.append("update")
            self.held = value

        def put(self, values):
            self.update(values)

        def appendList(self, values):
            self.update((self.held or []) + values)

        def clear(self):
            self.update(None)

    class Handle:
        getListState = getValueState = getMapState = lambda self, *a: State()
        registerTimer = deleteTimer = lambda self, ms: None

    class Now:
        getCurrentWatermarkInMs = lambda self: 900

    rows = [sliding.Row(us=1000 * i, event_id=i, value=float(i % 7)) for i in range(1000)]
    s = sliding.Sliding()
    s.init(Handle())
    assert not list(s.handleInputRows((1,), iter(random.Random(1).sample(rows, 1000)), None))
    told = list(s.handleExpiredTimer((1,), Now(), None))
    assert [r.event_id for r in told] == list(range(900)) and len(s.waiting.held) == 100 and len(calls) < 20
    assert told[-1].overall == pytest.approx(sum(i % 7 for i in range(900)) / 900) and told[-1].top == 6.0
