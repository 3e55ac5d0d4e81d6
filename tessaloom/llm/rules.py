"""Ordered rule lists by incremental reduced-error pruning (IREP) on a bounded sample of labelled rows."""

from __future__ import annotations

import numpy as np

#: Most labelled rows that a list is induced from.
MOST_ROWS = 20_000
Condition = tuple[int, str, float]


def _covered(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for feature, sign, threshold in rule:
        hit &= x[:, feature] > threshold if sign == ">" else x[:, feature] <= threshold
    return hit


def _best_condition(x: np.ndarray, y: np.ndarray) -> tuple[float, Condition] | None:
    """The condition of highest FOIL gain; thresholds lie in the middle between neighbouring values."""
    total, positive = len(y), int(y.sum())
    if not positive or positive == total:
        return None
    before, best = np.log2(positive / total), None
    for feature in range(x.shape[1]):
        order = np.argsort(x[:, feature], kind="stable")
        values, up = x[order, feature], np.cumsum(y[order])
        at = np.flatnonzero(values[1:] > values[:-1])
        if not len(at):
            continue
        middles = (values[at] + values[at + 1]) / 2
        for sign, p, n in ((">", positive - up[at], total - 1 - at), ("<=", up[at], at + 1)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - before), -1)
            # of equal gains the widest gap between the two values
            top = np.flatnonzero(gain >= gain.max() - 1e-9)
            k = top[np.argmax((values[at + 1] - values[at])[top])]
            if best is None or gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), (feature, sign, float(middles[k])))
    return best if best and best[0] > 0 else None


def _grow(x: np.ndarray, y: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < 6 and (found := _best_condition(x, y)):
        rule.append(found[1])
        hit = _covered(rule[-1:], x)
        x, y = x[hit], y[hit]
    return rule


def _worth(rule: list[Condition], x: np.ndarray, y: np.ndarray) -> float:
    hit = _covered(rule, x)
    p, n = int((hit & y).sum()), int((hit & ~y).sum())
    return (p - n) / (p + n) if p + n else -1.0


def induce(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list[list[Condition]]:
    """Rules for y, in order: each grown on two thirds of what no rule covers yet, pruned on the rest.

    A final sequence of conditions is dropped where that raises (p - n) / (p + n)
    on the pruning rows; the list ends with the first rule that is wrong on half
    of them or more.
    """
    if len(x) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} labelled rows")
    rng, out = np.random.default_rng(seed), []
    y = y.astype(bool)
    while y.any():
        # both classes in both parts
        grow = np.zeros(len(y), bool)
        for kind in (True, False):
            of = rng.permutation(np.flatnonzero(y == kind))
            grow[of[: max(1, round(len(of) * 2 / 3))]] = True
        rule = _grow(x[grow], y[grow])
        if not rule:
            break
        lengths = range(1, len(rule) + 1)
        rule = rule[: max(lengths, key=lambda n: (_worth(rule[:n], x[~grow], y[~grow]), -n))]
        if _worth(rule, x[~grow], y[~grow]) <= 0:
            break
        out.append(rule)
        left = ~_covered(rule, x)
        x, y = x[left], y[left]
    return out
