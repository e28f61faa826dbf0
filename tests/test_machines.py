"""State machines over a stream: shuffled micro-batches, a restart from the checkpoint, timers, against a fold in Python."""

import collections
import datetime as dt
import random

from larkspur.streaming import feed, machines

SCHEMA = "id long, at timestamp, seq long, kind string, who string, error string"
START = dt.datetime(2024, 1, 1)


def told(rng, ids):
    out = []
    for i in range(ids):
        at = rng.randint(0, 60)
        out.append((i, at, "enqueue"))
        for _ in range(rng.randint(0, 8)):
            at += rng.choice([0, 1, 5, 29, 30, 31, 45])
            out.append((i, at, rng.choice(["claim", "claim", "claim", "finish", "fail", "retry", "cancel", "odd", "enqueue"])))
    return [(i, START + dt.timedelta(minutes=a), n, k, f"w{n % 3}", "e" * (n % 2000)) for n, (i, a, k) in enumerate(out)]


def fold(events, until):
    """What the batch operators say, one event after the other."""
    state = {}
    for i, at, _, kind, who, error in sorted(events, key=lambda e: (e[1], e[2])):
        if at > until:
            continue
        release(state, i, at)
        s = state.setdefault(i, [None, 0, None, None, None])
        if kind == "enqueue" and s[0] is None:
            s[0] = "pending"
        elif kind == "claim" and s[0] == "pending":
            s[:4] = "in_progress", s[1] + 1, at, who
        elif kind in ("finish", "fail") and s[0] == "in_progress":
            s[0] = "completed" if kind == "finish" else "failed"
            s[4] = error[:1000] if kind == "fail" else None
        elif kind == "retry" and s[0] == "failed" and s[1] < 3:
            s[0], s[2:] = "pending", [None, None, None]
        elif kind == "cancel" and s[0] == "pending":
            s[0] = "cancelled"
    for i in state:
        release(state, i, until)
    return {i: tuple(s) for i, s in state.items() if s[0]}


def release(state, i, now):
    s = state.get(i)
    if s and s[0] == "in_progress" and now - s[2] >= dt.timedelta(minutes=30):
        s[0], s[2], s[3] = "pending", None, None


def test_shuffled_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(5)
    events = told(rng, 40)
    until = max(e[1] for e in events)
    # one far event of its own row moves the watermark up to the end of the others
    last = (10_000, until + dt.timedelta(hours=12), 0, "enqueue", None, None)
    batches = [[] for _ in range(4)]
    for e in events:
        batches[rng.randrange(4)].append(e)
    log, state, out = (str(tmp_path / x) for x in ("log", "state", "out"))

    def run():
        stream = machines.transitions(feed.open_log(spark, log, spark.createDataFrame([], SCHEMA).schema), "id", machines.queue_machine(), "12 hours")
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()

    for k, part in enumerate([*batches, [last]]):
        rng.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(log)
        if k in (1, 4):
            run()
    entered = spark.read.parquet(out)
    got = {r.id: (r.status, r.attempts, r.claimed_at, r.claimed_by, r.last_error) for r in machines.current(entered, "id").collect()}
    assert got == fold(events, until)
    assert collections.Counter(r.status for r in entered.collect())["in_progress"] > 20
    assert entered.groupBy("id", "nth").count().where("count > 1").count() == 0


def test_sync_machine():
    m, s = machines.sync_machine(), machines.State()
    for kind, want in [("running", None), ("open", "pending"), ("completed", "pending"), ("running", "running"), ("failed", "failed"), ("completed", "failed")]:
        s = m.step(s, kind, 7, None, "x" if kind == "failed" else None)
        assert s.status == want
    assert s.last_error == "x" and s.completed_at == 7 and m.due(s) is None
