"""When a delivery task sends what (K3, D2): due times, a rate limit and a
bounded number of requests in flight.

A request that is to be tried again waits in a priority queue ordered by its due
time (the endpoint's Retry-After, else the capped backoff) while other requests
go on: no request waits for another one's delay. Fresh requests are taken only
while the queue has room for all that are on their way, so a task holds at most
``queue_size`` requests besides the Arrow batch it reads.

The clock is a parameter: the real one sleeps, the virtual one only moves on, so
runs without waiting (and tests) go through the same schedule.
"""

from __future__ import annotations

import heapq
import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd

OUT_ROWS = 5_000  # attempt rows gathered before they are handed on


class RealClock:
    def time(self) -> float:
        return time.monotonic()

    def sleep(self, seconds: float) -> None:
        time.sleep(seconds)

    def jitter(self) -> float:
        """Part of a second added to a wait, so that tasks do not all come back at once."""
        return random.random()


class VirtualClock:
    def __init__(self) -> None:
        self.now = 0.0

    def time(self) -> float:
        return self.now

    def sleep(self, seconds: float) -> None:
        self.now += seconds

    def jitter(self) -> float:
        return 0.0


class TokenBucket:
    """At most ``size`` requests at once and ``size`` per ``period`` seconds on
    average, for one task."""

    def __init__(self, size: int, period: float, now: float):
        self.size, self.rate, self.tokens, self.at = size, size / period, float(size), now

    def available(self, now: float) -> int:
        self.tokens = min(float(self.size), self.tokens + (now - self.at) * self.rate)
        self.at = now
        return int(self.tokens + 1e-9)

    def take(self, n: int) -> None:
        self.tokens -= n

    def next_at(self) -> float:
        """When the next whole token is there."""
        return self.at + max(0.0, 1.0 - self.tokens) / self.rate


class DueQueue:
    """Waiting requests by due time, one heap per attempt number (the sender is
    told the attempt, so a group holds one)."""

    def __init__(self) -> None:
        self.heaps: dict[int, list] = {}
        self.size, self._order = 0, 0

    def push(self, due: float, attempt: int, row: tuple) -> None:
        self._order += 1
        heapq.heappush(self.heaps.setdefault(attempt, []), (due, self._order, row))
        self.size += 1

    def next_due(self) -> float | None:
        return min((h[0][0] for h in self.heaps.values() if h), default=None)

    def pop_due(self, now: float, limit: int) -> tuple[int, list[tuple]] | None:
        due = [(h[0][0], a) for a, h in self.heaps.items() if h and h[0][0] <= now]
        if not due:
            return None
        attempt = min(due)[1]
        heap, rows = self.heaps[attempt], []
        while heap and heap[0][0] <= now and len(rows) < limit:
            rows.append(heapq.heappop(heap)[2])
        self.size -= len(rows)
        return attempt, rows


class _Fresh:
    """Requests not sent yet, in slices of the incoming frames."""

    def __init__(self, frames: Iterator[pd.DataFrame]):
        self.frames, self.frame, self.at, self.done = iter(frames), None, 0, False

    def take(self, limit: int) -> pd.DataFrame | None:
        while not self.done and (self.frame is None or self.at >= len(self.frame)):
            self.frame, self.at = next(self.frames, None), 0
            self.done = self.frame is None
        if self.done:
            return None
        part = self.frame.iloc[self.at:self.at + limit].reset_index(drop=True)
        self.at += len(part)
        return part


def send_when_due(frames: Iterator[pd.DataFrame], sender, columns: list[str], *, classify: Callable, wait: Callable,
                  max_retries: int, clock, limit: int, queue_size: int, in_flight: int = 1,
                  rate: tuple[int, float] | None = None, carry: tuple = ()) -> Iterator[pd.DataFrame]:
    """One row per attempt of every request in ``frames``.

    ``classify(status, reason)`` names each response's class; ``wait(attempt,
    status, retry_after)`` the seconds until the next attempt. Each call of the
    sender gets at most ``limit`` requests; up to ``in_flight`` calls run at
    once. After a response of class ``abort`` nothing more is sent."""
    bucket = TokenBucket(rate[0], rate[1], clock.time()) if rate else None
    queue, fresh, out, held = DueQueue(), _Fresh(frames), [], 0
    pool = ThreadPoolExecutor(in_flight) if in_flight > 1 else None
    try:
        while True:
            groups, taken = [], 0
            while len(groups) < in_flight:
                now = clock.time()
                allowed = min(limit, bucket.available(now)) if bucket else limit
                group = None
                if allowed > 0:
                    due = queue.pop_due(now, allowed)
                    if due:
                        group = due[0], pd.DataFrame(due[1], columns=columns)
                    elif (room := queue_size - queue.size - taken) > 0:
                        part = fresh.take(min(allowed, room))
                        group = None if part is None else (1, part)
                if group is None:
                    break
                if bucket:
                    bucket.take(len(group[1]))
                taken += len(group[1])
                groups.append(group)
            if not groups:
                if fresh.done and not queue.size:
                    break
                times = [queue.next_due()] if queue.size else []
                if bucket and bucket.available(clock.time()) < 1:
                    times = [max([bucket.next_at(), *times])] if fresh.done or queue.size >= queue_size else [bucket.next_at()]
                clock.sleep(max(0.0, min(times) - clock.time()) + 1e-6)
                continue
            call = lambda g: sender(g[1], g[0]).reset_index(drop=True)
            for (attempt, pending), res in zip(groups, pool.map(call, groups) if pool else map(call, groups)):
                status = res["status"].to_numpy(dtype="int64")
                reason = res["reason"].astype(object).to_numpy()
                after = res["retry_after"].fillna(0).to_numpy(dtype="int64")
                cls = classify(status, reason)
                # An abort ends this group as it stands. It is a row, not an exception:
                # a failed task would be run again and resend everything.
                abort = bool((cls == "abort").any())
                done = (cls != "retry") | (attempt == max_retries + 1) | abort
                out.append(pd.DataFrame({
                    "request_id": pending["request_id"].to_numpy(),
                    "attempt": np.full(len(pending), attempt, dtype="int32"),
                    "status": status.astype("int32"), "reason": reason, "retry_after": after.astype("int32"),
                    "final": done, "data": np.where(done & (cls != "ok"), pending["data"].to_numpy(), None),
                    **{c: pending[c].to_numpy() for c in carry}}))
                held += len(pending)
                if abort:
                    yield pd.concat(out, ignore_index=True)
                    return
                again = np.flatnonzero(~done)
                if len(again):
                    now = clock.time()
                    rows = list(pending.iloc[again][columns].itertuples(index=False, name=None))
                    for i, row in zip(again, rows):
                        queue.push(now + wait(attempt, int(status[i]), int(after[i])) + clock.jitter(), attempt + 1, row)
            if held >= OUT_ROWS:
                yield pd.concat(out, ignore_index=True)
                out, held = [], 0
        if out:
            yield pd.concat(out, ignore_index=True)
    finally:
        if pool:
            pool.shutdown()
