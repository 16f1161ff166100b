"""Control-plane state: token buckets with reserves, breakers, disk guard, backoff, a queue bounded by bytes.

Clocks are passed in; nothing here sleeps.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import NamedTuple

from cairnflow import model


@dataclass
class TokenBucket:
    rate: float  # tokens a second
    burst: float
    tokens: float = field(default=-1.0)
    at: float = 0.0
    barred_until: float = float("-inf")

    def __post_init__(self) -> None:
        if self.tokens < 0:
            self.tokens = self.burst

    def refill(self, now: float) -> None:
        if now > self.at:
            self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
        self.at = max(self.at, now)

    def can(self, now: float, n: float = 1.0) -> bool:
        self.refill(now)
        return now >= self.barred_until and self.tokens + 1e-9 >= n

    def take(self, now: float, n: float = 1.0) -> bool:
        if not self.can(now, n):
            return False
        self.tokens -= n
        return True

    def wait(self, now: float, n: float = 1.0) -> float:
        self.refill(now)
        return max(0.0, self.barred_until - now, (n - self.tokens) / self.rate)

    def penalise(self, now: float, seconds: float) -> None:
        self.barred_until = max(self.barred_until, now + seconds)


def _bucket(per_minute: float) -> TokenBucket:
    """A bucket that holds what one second brings, a whole token at least."""
    rate = per_minute / 60
    return TokenBucket(rate, max(1.0, rate))


class HierarchicalLimiter:
    """A global rate with reserves: a child may go beyond its own reserve while its siblings have been idle for the
    time that refills one token. Grants never exceed the global bucket, and a reserve is always there for its child."""

    def __init__(self, global_per_minute: float, reserves: dict[str, float]):
        self.total = _bucket(global_per_minute)
        self.own = {k: _bucket(v) for k, v in reserves.items()}
        self.asked = dict.fromkeys(reserves, float("-inf"))
        self.acquired, self.denied = dict.fromkeys(reserves, 0), dict.fromkeys(reserves, 0)

    def acquire(self, child: str, now: float) -> bool:
        self.asked[child] = now
        own = self.own[child]
        idle = all(now - self.asked[k] > 1 / b.rate for k, b in self.own.items() if k != child)
        granted = now >= own.barred_until and self.total.can(now) and (own.can(now) or idle)
        if granted:
            self.total.take(now)
            own.take(now)
            self.acquired[child] += 1
        else:
            self.denied[child] += 1
        return granted

    def penalise(self, child: str, now: float, seconds: float) -> None:
        self.own[child].penalise(now, seconds)


class Breaker(NamedTuple):
    """A circuit breaker's state: failures in a row, when it opened (None: closed), whether a trial call is out. It never
    changes; the two functions below say which state comes next, so that a fold over any table or stream can use them."""

    streak: int = 0
    opened: float | None = None
    trial: bool = False

    @property
    def name(self) -> str:
        return "closed" if self.opened is None else "half_open" if self.trial else "open"


def admitted(b: Breaker, now: float, recovery: float = model.BREAKER_RECOVERY_S) -> Breaker | None:
    """The state with one more call under way; None where the call must wait. An open breaker lets a single trial
    through once ``recovery`` seconds have gone by."""
    if b.opened is None:
        return b
    return b._replace(trial=True) if not b.trial and now - b.opened >= recovery else None


def settled(b: Breaker, now: float, failed: bool, failures: int = model.BREAKER_FAILURES) -> Breaker:
    """The state after an admitted call's end: any success closes; a failed trial, or enough failures in a row, opens."""
    if not failed:
        return Breaker()
    opens = b.trial or b.streak + 1 >= failures
    return Breaker(b.streak + 1, now if opens else b.opened)


def folded(b: Breaker, calls: Iterable[tuple[float, bool]], failures: int = model.BREAKER_FAILURES, recovery: float = model.BREAKER_RECOVERY_S) -> Breaker:
    """The state after calls (time, failed) in order; those that are not admitted say nothing."""
    for now, failed in calls:
        under_way = admitted(b, now, recovery)
        if under_way is not None:
            b = settled(under_way, now, failed, failures)
    return b


@dataclass
class DiskGuard:
    """Paused below the floor, until there is the floor and a fifth more."""

    floor: int = model.DISK_FLOOR_BYTES
    hysteresis: float = model.DISK_HYSTERESIS
    paused: bool = False

    def check(self, free: int) -> bool:
        if self.paused:
            self.paused = free < self.floor * self.hysteresis
        else:
            self.paused = free < self.floor
        return self.paused


def backoff(attempts: int, base: float = model.BACKOFF_BASE_S, cap: float = model.BACKOFF_CAP_S, jitter: Callable[[], float] = lambda: 0.5) -> float:
    """jitter gives a number of [0, 1); the factor is between a half and one and a half."""
    return min(base * 2.0 ** (attempts - 1), cap) * (0.5 + jitter())


@dataclass
class KeyedBackoff:
    """Attempts and due times of keys; after the last allowed attempt a key is quarantined."""

    most: int = model.MAX_ATTEMPTS
    attempts: dict[str, int] = field(default_factory=dict)
    due: dict[str, float] = field(default_factory=dict)
    quarantined: set[str] = field(default_factory=set)

    def ready(self, key: str, now: float) -> bool:
        return key not in self.quarantined and self.due.get(key, now) <= now

    def retry(self, key: str, now: float, jitter: Callable[[], float] = lambda: 0.5) -> bool:
        """Whether this retry put the key into quarantine."""
        n = self.attempts[key] = self.attempts.get(key, 0) + 1
        if n > self.most:
            self.quarantined.add(key)
            return True
        self.due[key] = now + backoff(n, jitter=jitter)
        return False

    def clear(self, key: str) -> None:
        self.attempts.pop(key, None)
        self.due.pop(key, None)


class PendingSet:
    """Names in the order of arrival, each once; a requeue does not move one that is there."""

    def __init__(self) -> None:
        self.names: OrderedDict[str, None] = OrderedDict()

    def add(self, *names: str) -> None:
        for n in names:
            self.names.setdefault(n)

    def drain(self, limit: int) -> list[str]:
        return [self.names.popitem(last=False)[0] for _ in range(min(limit, len(self.names)))]


class ByteBudget:
    """Items in flight, charged by their bytes until they are released; one that is larger than the budget is let in
    when nothing else is in flight."""

    def __init__(self, most: int = model.HANDOFF_BYTES):
        self.most, self.used, self.items = most, 0, 0

    def offer(self, size: int) -> bool:
        if self.items and self.used + size > self.most:
            return False
        self.used, self.items = self.used + size, self.items + 1
        return True

    def release(self, size: int) -> None:
        self.used, self.items = self.used - size, self.items - 1
