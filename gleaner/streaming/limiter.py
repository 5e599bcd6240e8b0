"""Rate limits per address: fetches per time, connections and failures, by rules with hours of the day."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators.joins import micros
from gleaner.operators.ranged import gap_parts

OK, FULL, DROP = 0, -1, -2


@dataclass(frozen=True)
class Rule:
    """Limits of one address in a part of the day (seconds from midnight, end excluded; may pass midnight)."""

    max_connections: int = 15
    max_qps: float = 40.0
    start: int = 0
    end: int = 86400

    @classmethod
    def parse(cls, line: str) -> tuple[str, Rule]:
        """'address connections qps HH:MM-HH:MM'; ValueError for anything else."""
        parts = line.split()
        if len(parts) != 4:
            raise ValueError(f"not four fields: {line!r}")
        at = [int(h) * 3600 + int(m) * 60 for h, m in (x.split(":") for x in parts[3].split("-"))]
        if len(at) != 2 or not all(0 <= x <= 86400 for x in at) or int(parts[1]) <= 0 or float(parts[2]) <= 0:
            raise ValueError(f"bad limits: {line!r}")
        return parts[0], cls(int(parts[1]), float(parts[2]), *at)

    def holds(self, second: int) -> bool:
        if self.start <= self.end:
            return self.start <= second < self.end
        return second >= self.start or second < self.end


@dataclass
class State:
    window: int = -1  # start, in microseconds
    fetched: int = 0
    connections: int = 0
    failures: int = 0
    failed_at: int = 0
    hold: int = 0  # how long the address rests after the last failure


@dataclass
class Limiter:
    """Decisions for one address. Times are microseconds; nothing is read from a clock.

    `burst` fetches may fall into burst / qps seconds. From hold_after failures in a row on, the
    address rests after each failure, for a time between the bounds of hold_s that differs from
    failure to failure. check: 0 admits, a positive value is the earliest time to come again, -1
    means all connections are in use, -2 too many failures.
    """

    rules: list[Rule] = field(default_factory=lambda: [Rule()])
    burst: int = 10
    max_failures: int = 100
    hold_after: int = 10
    hold_s: tuple[float, float] = (5.0, 5.0)
    state: State = field(default_factory=State)

    def rule(self, at: int) -> Rule:
        second = at // 1_000_000 % 86400
        return next((r for r in self.rules if r.holds(second)), Rule())

    def check(self, at: int) -> int:
        s, r = self.state, self.rule(at)
        if s.failures >= self.max_failures:
            return DROP
        ends = s.window + int(self.burst / r.max_qps * 1_000_000)
        if s.window >= 0 and at < ends and s.fetched >= self.burst:
            return ends
        if s.failures >= self.hold_after and at < s.failed_at + s.hold:
            return s.failed_at + s.hold
        return FULL if s.connections >= r.max_connections else OK

    def register(self, at: int) -> None:
        s, width = self.state, int(self.burst / self.rule(at).max_qps * 1_000_000)
        if s.window < 0 or at >= s.window + width:
            s.window, s.fetched = at, 0
        s.fetched += 1
        s.connections += 1

    def release(self, success: bool, at: int = 0) -> None:
        s = self.state
        s.connections = max(0, s.connections - 1)
        s.failures = 0 if success else s.failures + 1
        if not success:
            low, high = self.hold_s
            spread = s.failures * 0.6180339887498949 % 1  # spreads over the bounds without chance
            s.failed_at, s.hold = at, int((low + (high - low) * spread) * 1_000_000)


class Fetcher:
    """The limiters of one fetcher's addresses under one limit of all its connections.

    Addresses that have nothing to remember (no connection, no failure, window over) are forgotten
    once there are more than `keep` of them.
    """

    def __init__(self, max_total: int = 1000, keep: int = 100_000, **limits):
        self.max_total, self.keep, self.limits = max_total, keep, limits
        self.connections, self.known = 0, {}

    def _of(self, address: str, at: int) -> Limiter:
        if address not in self.known and len(self.known) >= self.keep:
            busy = lambda x: x.state.connections or x.state.failures or at < x.state.window + int(x.burst / x.rule(at).max_qps * 1_000_000)
            self.known = {k: x for k, x in self.known.items() if busy(x)}
        return self.known.setdefault(address, Limiter(**self.limits))

    def check(self, address: str, at: int) -> int:
        got = self._of(address, at).check(at)
        return FULL if got == OK and self.connections >= self.max_total else got

    def register(self, address: str, at: int) -> None:
        self._of(address, at).register(at)
        self.connections += 1

    def release(self, address: str, success: bool, at: int) -> None:
        self._of(address, at).release(success, at)
        self.connections -= 1


def simulate(jobs: DataFrame, key: str, ts: str, order: str, fetch_s: float = 1.0, **limits) -> DataFrame:
    """key, order, decision, wait_s of each job against its key's limiter, in order of time.

    A fetch holds its connection for fetch_s seconds and succeeds. After a gap in which every
    connection has been given back and the window is over, a limiter remembers nothing: there a
    key's jobs are cut, and each part streams through a task with constant state. Null keys and
    null times are left out.
    """
    width = max(limits.get("burst", 10) / r.max_qps for r in [*limits.get("rules", []), Rule()])
    idle = int(max(fetch_s, width) * 1_000_000) + 1
    rows = jobs.filter(F.col(key).isNotNull()).select(key, order, micros(ts).alias("_at")).filter("_at IS NOT NULL")
    rows = gap_parts(rows, [key], F.col("_at"), F.col("_gap") > idle, ["_at", order], "_part")
    rows = rows.repartition(key, "_part").sortWithinPartitions(key, "_part", "_at", order)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who, limiter, busy, hold = None, None, deque(), int(fetch_s * 1e6)
        for pdf in parts:
            out = []
            for k, part, at in zip(pdf[key], pdf["_part"], pdf["_at"]):
                if (k, part) != who:
                    who, limiter, busy = (k, part), Limiter(**limits), deque()
                while busy and busy[0] <= at:
                    limiter.release(True, busy.popleft())
                got = limiter.check(at)
                if got == OK:
                    limiter.register(at)
                    busy.append(at + hold)
                out.append(("ok", 0.0) if got == OK else ("full", 0.0) if got == FULL else ("drop", 0.0) if got == DROP else ("wait", (got - at) / 1e6))
            yield pd.DataFrame({key: pdf[key], order: pdf[order], "decision": [d for d, _ in out], "wait_s": [w for _, w in out]})

    return rows.mapInPandas(scan, f"`{key}` {types[key]}, `{order}` {types[order]}, decision string, wait_s double")
