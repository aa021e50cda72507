"""Adaptive proposals for a parameter search: Parzen densities of good and bad trials.

The trials so far are cut into the best share and the rest. Each parameter gets one
density of either part: a mixture of the prior and one bump for every trial. Values are
drawn from the density of the good trials, and of several draws the one is taken whose
density among the good is largest against that among the bad.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence

GOOD_SHARE = 0.1
STARTUP = 6
CANDIDATES = 24


def draw(space: Mapping[str, tuple], rng: random.Random) -> dict:
    """One random setting. ``("int", lo, hi)``, ``("float", lo, hi)``, ``("log", lo, hi)``
    (evenly on a log scale) or ``("choice", [..])`` for each parameter."""
    return {name: _prior(kind, rng) for name, kind in space.items()}


def _prior(kind: tuple, rng: random.Random):
    name, *args = kind
    if name == "int":
        return rng.randint(*args)
    if name == "float":
        return rng.uniform(*args)
    if name == "log":
        return math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
    if name == "choice":
        return rng.choice(args[0])
    raise ValueError(f"unknown parameter kind {name!r}")


class Density:
    """Density of one parameter over the values of some trials."""

    def __init__(self, kind: tuple, values: Sequence):
        self.kind, self.values = kind, list(values)
        if kind[0] == "choice":
            self.options = list(kind[1])
            return
        self.low, self.high = (self._inner(v) for v in kind[1:])
        if kind[0] == "int":  # a whole number stands for the unit around it
            self.low, self.high = self.low - 0.5, self.high + 0.5
        self.span = max(self.high - self.low, 1e-12)
        self.centres = [self._inner(v) for v in self.values]
        self.width = self._bandwidth()

    def _inner(self, value) -> float:
        return math.log(value) if self.kind[0] == "log" else float(value)

    def _bandwidth(self) -> float:
        # from the range alone: from the spread of the values it would shrink onto the
        # first good ones, and the search would stay there
        return self.span / 5 * max(len(self.centres), 1) ** -0.125

    def draw(self, rng: random.Random):
        pick = rng.randrange(len(self.values) + 1)
        if pick == len(self.values):
            return _prior(self.kind, rng)
        if self.kind[0] == "choice":
            return self.values[pick]
        while True:  # a bump around a value inside the range: half of it lies inside
            value = rng.gauss(self.centres[pick], self.width)
            if self.low <= value <= self.high:
                break
        if self.kind[0] == "int":
            return min(max(round(value), self.kind[1]), self.kind[2])
        return math.exp(value) if self.kind[0] == "log" else value

    def log(self, value) -> float:
        n = len(self.values)
        if self.kind[0] == "choice":
            return math.log((self.values.count(value) + 1 / len(self.options)) / (n + 1))
        x, total = self._inner(value), 1 / self.span
        for centre in self.centres:
            inside = _normal((self.high - centre) / self.width) - _normal((self.low - centre) / self.width)
            bump = math.exp(-0.5 * ((x - centre) / self.width) ** 2) / (self.width * math.sqrt(2 * math.pi))
            total += bump / inside
        return math.log(total / (n + 1))


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def propose(
    space: Mapping[str, tuple],
    trials: Sequence[tuple[dict, float]],
    rng: random.Random,
    count: int = 1,
) -> list[dict]:
    """The next ``count`` settings after (setting, score) trials; higher scores are better.

    The first STARTUP settings are random. Settings of one batch, whose scores are not
    known yet, count as bad ones for the rest of the batch, so that it spreads out.
    Scores that are not numbers are worse than all others.
    """
    ranked = sorted(trials, key=lambda t: -math.inf if math.isnan(t[1]) else t[1], reverse=True)
    out: list[dict] = []
    while len(out) < count:
        if len(trials) + len(out) < STARTUP:
            out.append(draw(space, rng))
            continue
        cut = max(1, math.ceil(GOOD_SHARE * len(ranked)))
        good = [t for t, _ in ranked[:cut]]
        bad = [t for t, _ in ranked[cut:]] + out
        setting = {}
        for name, kind in space.items():
            of_good = Density(kind, [t[name] for t in good])
            of_bad = Density(kind, [t[name] for t in bad])
            drawn = [of_good.draw(rng) for _ in range(CANDIDATES)]
            setting[name] = max(drawn, key=lambda v: of_good.log(v) - of_bad.log(v))
        out.append(setting)
    return out
