"""Adaptive parameter search by tree-structured Parzen estimates.

The better part of the trials so far and the rest are each turned into a density per
parameter; the next settings are those drawn from the first that are likeliest under it
compared with the second.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

#: Random trials at first, share of trials that count as good, and draws per choice.
STARTS, GOOD_SHARE, DRAWS = 10, 0.25, 24


@dataclass(frozen=True)
class Range:
    """Values from `low` to `high`, even in their logarithm if `log`, whole numbers if `whole`."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def value(self, unit: float) -> float | int:
        """The value at a place between 0 and 1."""
        if self.whole:
            return min(int(self.high), int(self.low + unit * (self.high - self.low + 1)))
        if self.log:
            return math.exp(math.log(self.low) + unit * (math.log(self.high) - math.log(self.low)))
        return self.low + unit * (self.high - self.low)


@dataclass(frozen=True)
class Density:
    """A mixture of an even density on [0, 1] and one bell per known place, cut off at the ends."""

    centres: tuple[float, ...]
    widths: tuple[float, ...]

    @classmethod
    def of(cls, places: Sequence[float]) -> Density:
        ordered = sorted(places)
        edges = [0.0, *ordered, 1.0]
        widest, narrowest = 1.0, 1.0 / min(100, len(ordered) + 2)
        widths = [min(widest, max(narrowest, edges[k + 1] - edges[k], edges[k + 2] - edges[k + 1])) for k in range(len(ordered))]
        return cls(tuple(ordered), tuple(widths))

    def draw(self, rng: random.Random) -> float:
        k = rng.randrange(len(self.centres) + 1)
        while k:
            found = rng.gauss(self.centres[k - 1], self.widths[k - 1])
            if 0 <= found <= 1:
                return found
        return rng.random()

    def log(self, x: float) -> float:
        total = 1.0
        for c, w in zip(self.centres, self.widths):
            inside = (math.erf((1 - c) / w / math.sqrt(2)) + math.erf(c / w / math.sqrt(2))) / 2
            total += math.exp(-(((x - c) / w) ** 2) / 2) / (w * math.sqrt(2 * math.pi) * inside)
        return math.log(total / (len(self.centres) + 1))


def propose(trials: Sequence[tuple[dict[str, float], float]], names: Sequence[str], rng: random.Random) -> dict[str, float]:
    """Places in [0, 1] of the next trial, from (places, score) of those done; a larger score is better."""
    if len(trials) < STARTS:
        return {n: rng.random() for n in names}
    ranked = sorted(trials, key=lambda t: -t[1])
    good = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    found = {}
    for name in names:
        better, rest = (Density.of([t[0][name] for t in part]) for part in (ranked[:good], ranked[good:]))
        found[name] = max((better.draw(rng) for _ in range(DRAWS)), key=lambda x: better.log(x) - rest.log(x))
    return found


def batched_search(
    space: dict[str, Range], scores: Callable[[list[dict[str, Any]]], list[float]], trials: int, seed: int = 42, parallelism: int = 1
) -> list[tuple[dict[str, Any], float]]:
    """All (setting, score) tried, in order. `scores` gets `parallelism` settings at a time, proposed from those done before.

    The random trials at first look at no score, so their settings come all at once.
    """
    rng, done, found = random.Random(seed), [], []
    while len(found) < trials:
        places: list[dict[str, float]] = []
        while not places or len(done) + len(places) < min(STARTS, trials):
            some = min(max(parallelism, 1), trials - len(found) - len(places))
            places += [propose(done, list(space), rng) for _ in range(some)]
        settings = [{n: space[n].value(p[n]) for n in space} for p in places]
        reached = [float(s) for s in scores(settings)]
        done += zip(places, reached)
        found += zip(settings, reached)
    return found


def adaptive_search(
    space: dict[str, Range], score: Callable[[dict[str, Any]], float], trials: int, seed: int = 42, parallelism: int = 1
) -> list[tuple[dict[str, Any], float]]:
    """As `batched_search`, with a `score` of one setting; `parallelism` of them are scored at a time."""
    with ThreadPoolExecutor(max_workers=max(parallelism, 1)) as pool:
        return batched_search(space, lambda settings: list(pool.map(score, settings)), trials, seed, parallelism)
