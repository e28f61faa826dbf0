"""The queue and the sync log as state machines over a stream of events, a state for each row.

Events of a key are taken in the order of their time, whatever micro-batch brings them: they wait in the state until the
watermark has passed. A claim that nothing ends within its time is released by a timer of event time.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from larkspur.operators.merge import SYNC_STEPS

MINUTE = 60_000_000


@dataclass(frozen=True)
class State:
    """Of a queue row or a sync: times are microseconds since 1970."""

    status: str | None = None
    attempts: int = 0
    claimed_at: int | None = None
    claimed_by: str | None = None
    completed_at: int | None = None
    last_error: str | None = None


@dataclass(frozen=True)
class Machine:
    """``step(state, kind, at, who, error)`` gives the next state, or the same where the event doesn't fit. ``due(state)`` is when a
    state ends by itself, or None, and ``expire(state)`` is the state after that."""

    step: Callable[[State, str, int, str | None, str | None], State]
    due: Callable[[State], int | None] = lambda state: None
    expire: Callable[[State], State] = lambda state: state


def queue_machine(minutes: int = 30, most: int = 3) -> Machine:
    """enqueue, claim, finish, fail, retry and cancel of a queue row; a claim is released after ``minutes``, attempts stay."""

    def step(s: State, kind: str, at: int, who: str | None, error: str | None) -> State:
        match kind, s.status:
            case "enqueue", None:
                return replace(s, status="pending")
            case "claim", "pending":
                return replace(s, status="in_progress", attempts=s.attempts + 1, claimed_at=at, claimed_by=who)
            case "finish", "in_progress":
                return replace(s, status="completed", completed_at=at)
            case "fail", "in_progress":
                return replace(s, status="failed", completed_at=at, last_error=(error or "")[:1000])
            case "retry", "failed" if s.attempts < most:
                return State("pending", s.attempts)
            case "cancel", "pending":
                return replace(s, status="cancelled")
        return s

    return Machine(
        step, lambda s: s.claimed_at + minutes * MINUTE if s.status == "in_progress" else None, lambda s: replace(s, status="pending", claimed_at=None, claimed_by=None)
    )


def sync_machine() -> Machine:
    """open, and the kinds running, completed and failed of a sync, each from where it may follow."""

    def step(s: State, kind: str, at: int, who: str | None, error: str | None) -> State:
        if kind == "open" and s.status is None:
            return replace(s, status="pending")
        if kind in SYNC_STEPS.get(s.status, ()):
            return replace(s, status=kind, completed_at=None if kind == "running" else at, last_error=error or s.last_error)
        return s

    return Machine(step)


_STATE = "status string, attempts int, claimed_at long, claimed_by string, completed_at long, last_error string"


def _advance(machine: Machine, state: State, events: list[tuple], until: int) -> tuple[State, list[tuple[int, State]], list[tuple]]:
    """The state at ``until``, the transitions that lead there with their times, and the events that are later."""
    out, i = [], 0
    while True:
        at = events[i][0] if i < len(events) and events[i][0] <= until else None
        due = machine.due(state)
        if due is not None and due <= until and (at is None or due <= at):
            state = machine.expire(state)
            out.append((due, state))
        elif at is not None:
            new = machine.step(state, events[i][2], at, *events[i][3:5])
            i += 1
            if new != state:
                out.append((at, new))
            state = new
        else:
            return state, out, events[i:]


#: Groups that the keys of a stream are dealt to. A batch takes some milliseconds a group and reads the state of each group that it
#: touches whole, some hundred bytes a key: more groups for more than some ten million keys. A stream keeps its number.
GROUPS = 1024


def transitions(events: DataFrame, key: str, machine: Machine, late: str = "1 hour", groups: int = GROUPS) -> DataFrame:
    """(key, at, nth, status, attempts, claimed_at, claimed_by, completed_at, last_error): each state that a key enters, append-only.

    events: (key, at, seq, kind, who, error), a stream; ``key`` is a bigint and seq orders events of the same time. A timer that is due
    at the time of an event comes first. Events that are later than the watermark allows are dropped, repeated ones don't fit
    their state and do nothing, and what is newer than the watermark isn't decided yet. Keys are dealt to ``groups`` by their hash; the
    state of a group holds the row of each of its keys, the events that wait, and when the key has to be looked at again.
    """
    entered = {key: "int64", "at": "int64", "nth": "int32", "status": object, "attempts": "int32", "claimed_at": "Int64", "claimed_by": object, "completed_at": "Int64", "last_error": object}

    def step(_: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        # key: (its state, how many it has entered, waiting events, when to look again)
        keys = pickle.loads(held.get[0]) if held.exists else {}
        mark, came = held.getCurrentWatermarkMs(), defaultdict(list)
        if not held.hasTimedOut:
            for f in frames:
                for i, *event in zip(*(f[c].tolist() for c in (key, "micros", "seq", "kind", "who", "error"))):
                    came[i].append(tuple(event))
        out = []
        for i in {*came, *(i for i, (*_, wake) in keys.items() if wake is not None and wake <= mark * 1000)}:
            own, nth, waiting, _ = keys.get(i, ((), 0, [], None))
            todo = sorted([*waiting, *came.get(i, ())], key=lambda x: x[:3])
            state, done, rest = _advance(machine, State(*own), todo, mark * 1000)
            out += [(i, at, nth + k, *s.__dict__.values()) for k, (at, s) in enumerate(done, 1)]
            keys[i] = tuple(state.__dict__.values()), nth + len(done), rest, min((x for x in (rest[0][0] if rest else None, machine.due(state)) if x is not None), default=None)
        held.update((pickle.dumps(keys),))
        wakes = [wake for *_, wake in keys.values() if wake is not None]
        if wakes:
            held.setTimeoutTimestamp(max(mark + 1, -(-min(wakes) // 1000)))
        if out:
            yield pd.DataFrame({c: pd.Series(v, dtype=kind) for (c, kind), v in zip(entered.items(), zip(*out))})

    dealt = F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")
    marked = events.withWatermark("at", late).select(key, "at", F.unix_micros("at").alias("micros"), "seq", "kind", "who", "error", dealt.alias("dealt"))
    rows = marked.groupBy("dealt").applyInPandasWithState(step, f"{key} long, at long, nth int, {_STATE}", "packed binary", "append", GroupStateTimeout.EventTimeTimeout)
    return rows.select(key, *[F.timestamp_micros(c).alias(c) if c in ("at", "claimed_at", "completed_at") else c for c in rows.columns[1:]])


def current(entered: DataFrame, key: str) -> DataFrame:
    """The last state of each key, of a table of transitions."""
    rest = [c for c in entered.columns if c != key]
    return entered.groupBy(key).agg(F.max_by(F.struct(*rest), "nth").alias("r")).select(key, "r.*")
