"""Sequential model-based parameter search (ML4): densities of good and bad trials.

After ``STARTUP`` random draws, each parameter gets two densities, one of its values in the best
trials and one of its values in the others (normals around them within the range, or smoothed
counts of choices, each with a prior); of ``CANDIDATES`` draws from the first, the one that the first
favours most over the second is tried next.  Scores are maximised; everything is fixed by the seed.
The published method is Bergstra et al. 2011.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

STARTUP = 10
CANDIDATES = 24
GOOD_SHARE = 0.1
MOST_GOOD = 25

#: name -> ("int", lo, hi) or ("float", lo, hi), ends included, or ("choice", values)
Space = dict[str, tuple]


@dataclass
class Study:
    space: Space
    seed: int
    trials: list[tuple[dict, float]] = field(default_factory=list)

    def __post_init__(self):
        self.rng = np.random.default_rng(self.seed)

    def suggest(self, n: int) -> list[dict]:
        """The next n parameter sets, drawn from what is known now."""
        known = len(self.trials)
        return [self._random() if known + i < STARTUP or not known else self._promising() for i in range(n)]

    def tell(self, params: dict, score: float) -> None:
        self.trials.append((params, score))

    def best(self) -> tuple[dict, float]:
        """The earliest of the best trials."""
        return max(self.trials, key=lambda t: t[1])

    def _random(self) -> dict:
        out = {}
        for name, (kind, *what) in self.space.items():
            if kind == "choice":
                out[name] = what[0][int(self.rng.integers(len(what[0])))]
            elif kind == "int":
                out[name] = int(self.rng.integers(what[0], what[1] + 1))
            else:
                out[name] = float(self.rng.uniform(what[0], what[1]))
        return out

    def _promising(self) -> dict:
        order = sorted(range(len(self.trials)), key=lambda i: (-self.trials[i][1], i))
        n = min(MOST_GOOD, math.ceil(GOOD_SHARE * len(order)))
        out = {}
        for name, (kind, *what) in self.space.items():
            good, bad = ([self.trials[i][0][name] for i in part] for part in (order[:n], order[n:]))
            out[name] = self._choice(what[0], good, bad) if kind == "choice" else self._number(kind, *what, good, bad)
        return out

    def _choice(self, values: list, good: list, bad: list):
        p, q = (np.array([1.0 + sum(x == v for x in part) for v in values]) for part in (good, bad))
        p, q = p / p.sum(), q / q.sum()
        drawn = self.rng.choice(len(values), CANDIDATES, p=p)
        return values[int(drawn[np.argmax((np.log(p) - np.log(q))[drawn])])]

    def _number(self, kind: str, lo, hi, good: list, bad: list):
        # an integer stands for the range around it
        a, b = (lo - 0.5, hi + 0.5) if kind == "int" else (float(lo), float(hi))
        at, width = _kernels(good, a, b)
        pick = self.rng.integers(len(at), size=CANDIDATES)
        drawn = _truncated(self.rng, at[pick], width[pick], a, b)
        if kind == "int":
            drawn = np.clip(np.rint(drawn), lo, hi)
        gain = _density(drawn, at, width, a, b) - _density(drawn, *_kernels(bad, a, b), a, b)
        best = drawn[int(np.argmax(gain))]
        return int(best) if kind == "int" else float(best)


def _kernels(values: list, a: float, b: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres and widths: the values and the middle of the range (the prior), each as wide as its farther neighbour is off."""
    x = np.array([*values, (a + b) / 2], float)
    order = np.argsort(x, kind="stable")
    edges = np.concatenate([[a], x[order], [b]])
    width = np.empty(len(x))
    width[order] = np.maximum(edges[1:-1] - edges[:-2], edges[2:] - edges[1:-1])
    width = np.clip(width, (b - a) / min(100, len(x) + 1), b - a)
    width[-1] = b - a
    return x, width


def _cdf(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf)(z / math.sqrt(2)))


def _truncated(rng: np.random.Generator, at: np.ndarray, width: np.ndarray, a: float, b: float) -> np.ndarray:
    out = np.full(len(at), np.nan)
    while np.isnan(out).any():
        drawn = rng.normal(at, width)
        out = np.where(np.isnan(out) & (a <= drawn) & (drawn <= b), drawn, out)
    return out


def _density(x: np.ndarray, at: np.ndarray, width: np.ndarray, a: float, b: float) -> np.ndarray:
    """Log of the mean of the truncated normals."""
    z = (x[:, None] - at) / width
    inside = _cdf((b - at) / width) - _cdf((a - at) / width)
    return np.log((np.exp(-0.5 * z * z) / (width * inside)).mean(1) + 1e-300)
