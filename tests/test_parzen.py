"""Adaptive proposals: ranges, seeds, and against random draws on a fixed objective."""

import math
import random

import pytest

from fieldmill.learn import parzen as P

SPACE = {
    "depth": ("int", 2, 12),
    "rate": ("log", 0.001, 1.0),
    "share": ("float", 0.2, 1.0),
    "kind": ("choice", ["a", "b", "c"]),
}


def objective(p):
    return (
        -(((p["depth"] - 9) / 4) ** 2)
        - (math.log10(p["rate"]) + 1.7) ** 2
        - (2 * (p["share"] - 0.35)) ** 2
        - (p["kind"] != "b")
    )


def run(seed, rounds, adaptive, batch=2):
    rng, trials = random.Random(seed), []
    while len(trials) < rounds:
        new = P.propose(SPACE, trials, rng, batch) if adaptive else [P.draw(SPACE, rng)]
        trials += [(p, objective(p)) for p in new]
    return max(score for _, score in trials[:rounds])


def test_beats_random_draws():
    adaptive = [run(seed, 50, True) for seed in range(20)]
    plain = [run(seed, 50, False) for seed in range(20)]
    assert sum(a > b for a, b in zip(adaptive, plain)) >= 15
    assert sum(adaptive) / 20 > 0.6 * sum(plain) / 20  # scores are below zero


def test_settings_stay_in_range_and_follow_the_seed():
    trials = [(P.draw(SPACE, random.Random(k)), float(k % 7)) for k in range(30)] + [
        (P.draw(SPACE, random.Random(99)), float("nan"))
    ]
    first = P.propose(SPACE, trials, random.Random(4), 200)
    assert first == P.propose(SPACE, trials, random.Random(4), 200)
    for p in first:
        assert 2 <= p["depth"] <= 12 and isinstance(p["depth"], int)
        assert 0.001 <= p["rate"] <= 1 and 0.2 <= p["share"] <= 1 and p["kind"] in "abc"
    assert len({str(p) for p in first}) > 190
    with pytest.raises(ValueError):
        P.draw({"x": ("odd", 1, 2)}, random.Random(1))


def test_densities_add_up_to_one():
    for kind, values in ((("float", -1.0, 3.0), [0.0, 2.9]), (("log", 0.01, 10.0), [0.02]), (("float", 0.0, 1.0), [])):
        density = P.Density(kind, values)
        low, high = density.low, density.high
        points = [low + (high - low) * (k + 0.5) / 4000 for k in range(4000)]
        inner = math.exp if kind[0] == "log" else float
        total = sum(math.exp(density.log(inner(x))) for x in points) * (high - low) / 4000
        assert total == pytest.approx(1, abs=1e-3)
    density = P.Density(("choice", ["a", "b", "c"]), ["b", "b"])
    assert sum(math.exp(density.log(v)) for v in "abc") == pytest.approx(1)
