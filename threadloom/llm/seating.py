"""Numbers of tables in a Pitman-Yor restaurant, drawn from their exact law.

Given the tables of all other dishes of a restaurant, the customers of a dish leave together and are seated again. Only
the number of their tables matters, and it has the law

    P(t)  ~  S(c, t) * chance ** t * (strength + discount * o) (strength + discount * (o + 1)) ... (t factors)

for ``c`` customers, ``o`` tables of other dishes and the dish's ``chance`` below. ``S(c, t)`` is the sum, over all ways to part
c customers into t tables, of the product of (1 - discount)(2 - discount)...(size - 1 - discount) over the tables: the
generalised Stirling number with ``S(c + 1, t) = S(c, t - 1) + (c - t * discount) S(c, t)``. Drawing t given everything else is a
Gibbs step on the whole seating of the dish, so a sweep needs no memory of who sat where.

Up to ``TABULATED`` customers S comes from the recurrence, in logarithms, and t is drawn from all of its odds. Beyond, a Metropolis
step keeps the same law: with c large, t - 1 is nearly a Poisson number, so one is proposed and taken or not by
the exact odds. These need S at two places only: from its closed sum while ``t <= SUMMED * c ** discount`` (its terms alternate
and are small there), and further on by the saddle point of its generating function ``((1 - (1 - x) ** discount) / discount) ** t / t!``,
joined to the sum where that ends; in between a test holds both against the recurrence.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

import numpy as np

TABULATED = 1024
#: How far the closed sum is used, in units of customers ** discount, and its terms.
SUMMED, TERMS = 2.0, 160
#: Logarithm below which odds are nothing beside the largest.
NOTHING = -32.0
#: Proposals for a dish in a sweep, beyond ``TABULATED`` customers.
PROPOSALS = 4
#: Odds computed at once.
TOGETHER = 1 << 19


@lru_cache(maxsize=4)
def table(discount: float) -> np.ndarray:
    """log S(c, t) at [c, t], up to ``TABULATED``."""
    out = np.full((TABULATED + 1, TABULATED + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, TABULATED):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore"):
            out[c + 1, 1 : c + 1] = np.log(c - t * discount) + out[c, 1 : c + 1]
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c + 1, 1 : c + 2], out[c, : c + 1])
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series; ``x`` positive."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for _ in range(8):  # until the series is exact to the last digits
        low = x < 8
        shift = np.where(low, shift - np.log(np.where(low, x, 1.0)), shift)
        x = np.where(low, x + 1, x)
    inverse = 1 / (x * x)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / x
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series


def _summed(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """The closed sum over j of (-1)^j C(t, j) Gamma(c - j d) / Gamma(-j d), over d^t t!."""
    total = np.zeros_like(c)
    first = log_gamma(c - discount)
    ways = np.zeros_like(c)  # log of C(t, j)
    for j in range(1, TERMS + 1):
        at = j * discount
        ways = ways + np.log(np.maximum(t - j + 1, 1e-300) / j)
        if abs(at - round(at)) < 1e-9:  # a pole of the gamma function below: the term is nothing
            continue
        sign = (-1.0) ** j * math.copysign(1.0, math.sin(-math.pi * at))
        size = math.lgamma(1 + at) + math.log(abs(math.sin(math.pi * at)) / math.pi)  # of 1 / Gamma(-at)
        term = np.where(t >= j, np.exp(ways + size + log_gamma(c - at) - first), 0.0)
        total += sign * term
        if not (term > 1e-17).any():
            break
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(total, 0.0)) + first - t * math.log(discount) - log_gamma(t + 1)


def _saddle(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log S by the saddle point, for 1 < t < c."""
    mean = c / t
    low, high = np.full(c.shape, -60.0), np.full(c.shape, -1e-12)  # of log(1 - x)

    def moments(left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log of the generating function, its first and its second logarithmic derivative in log x."""
        y = np.exp(left)  # 1 - x
        x = -np.expm1(left)
        rest = -np.expm1(discount * left)  # 1 - y ** discount
        first = x * discount * np.exp((discount - 1) * left) / rest
        second = first * (1 + x * (1 - discount) / y - first)
        return np.log(rest / discount), first, second

    for _ in range(60):
        middle = (low + high) / 2
        above = moments(middle)[1] > mean  # sizes shrink as x falls, that is as log(1 - x) rises
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    left = (low + high) / 2
    value, _, second = moments(left)
    spread = np.maximum(t * second, 1e-300)
    shape = log_gamma(c + 1) - log_gamma(t + 1) + t * value - c * np.log(-np.expm1(left))
    return shape - 0.5 * np.log(2 * math.pi * spread)


def log_stirling(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t) for more than ``TABULATED`` customers, ``1 <= t < c``."""
    c, t = (np.array(values, float) for values in np.broadcast_arrays(c, t))
    edge = np.minimum(np.floor(SUMMED * c**discount), c - 1)
    out = _summed(c, np.minimum(t, edge), discount)
    far = t > edge
    if far.any():
        out[far] += _saddle(c[far], t[far], discount) - _saddle(c[far], edge[far], discount)
    return out


def _log_rising(start: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """log of start (start + 1) ... , ``steps`` factors."""
    return log_gamma(start + steps) - log_gamma(start)


def _tabulated(c: int, others: np.ndarray, chance: np.ndarray, discount: float, strength: float, draw: np.random.Generator) -> np.ndarray:
    """Draws for dishes of ``c`` customers each."""
    known = table(discount)[c, 1 : c + 1]
    t = np.arange(c)
    most, best = others.max(), chance.max()
    # The odds with the largest weights say how many tables have to be looked at for any of the dishes.
    greatest = known + np.cumsum(np.log(strength + discount * (most + t)) + math.log(best))
    some = np.flatnonzero(greatest > greatest.max() + NOTHING)[-1] + 1
    out = np.empty(len(others), np.int64)
    step = max(1, TOGETHER // some)
    for start in range(0, len(others), step):
        rows = slice(start, start + step)
        odds = np.log(strength + discount * (others[rows, None] + t[:some])) + np.log(chance[rows])[:, None]
        np.cumsum(odds, axis=1, out=odds)
        odds += known[:some]
        odds -= odds.max(axis=1, keepdims=True)
        np.exp(odds, out=odds)
        np.cumsum(odds, axis=1, out=odds)
        out[rows] = 1 + (odds < (draw.random(len(odds)) * odds[:, -1])[:, None]).sum(axis=1)
    return out


def _proposed(
    c: np.ndarray, others: np.ndarray, chance: np.ndarray, before: np.ndarray, discount: float, strength: float, draw: np.random.Generator
) -> np.ndarray:
    """The next state of dishes of more than ``TABULATED`` customers, from ``before`` (0: none yet)."""
    start = strength / discount + others
    # t - 1 is nearly Poisson with the mean of (strength + discount (others + t)) chance / discount at its own mean.
    mean = np.clip(chance * (start + 1) / np.maximum(1 - chance, 1e-3), 1e-9, c - 2)
    out = np.empty(len(c), np.int64)
    wide = mean > 0.5 * c**discount  # so many tables that their sizes are no longer free of each other
    for some, step in ((~wide, _poisson_steps), (wide, _normal_steps)):
        if some.any():
            of = c[some], start[some]

            def law(t: np.ndarray, of: tuple = of, weight: np.ndarray = np.log(chance[some] * discount)) -> np.ndarray:
                return log_stirling(of[0], t, discount) + _log_rising(of[1], t) + t * weight

            out[some] = step(law, c[some], mean[some], before[some], draw)
    return out


Law = Callable[[np.ndarray], np.ndarray]


def _steps(law: Law, c: np.ndarray, now: np.ndarray, propose: Callable[[], np.ndarray], density: Law, draw: np.random.Generator) -> np.ndarray:
    """Metropolis steps with proposals that don't depend on the state."""
    now = np.clip(now, 1, c - 1)
    held = law(now) - density(now)
    for _ in range(PROPOSALS):
        other = propose()
        inside = (other >= 1) & (other < c)
        other = np.where(inside, other, 1.0)
        value = np.where(inside, law(other) - density(other), -np.inf)
        taken = np.log(np.maximum(draw.random(len(c)), 1e-300)) < value - held
        now, held = np.where(taken, other, now), np.where(taken, value, held)
    return now


def _poisson_steps(law: Law, c: np.ndarray, mean: np.ndarray, before: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    now = np.where(before > 0, before, np.floor(mean) + 1)
    return _steps(law, c, now, lambda: 1.0 + draw.poisson(mean), lambda t: (t - 1) * np.log(mean) - log_gamma(t), draw)


def _normal_steps(law: Law, c: np.ndarray, mean: np.ndarray, before: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Around the mode, which is found by halving: the odds rise and then fall."""
    low, high = np.ones(len(c)), c - 1
    while (low < high).any():
        middle = np.floor((low + high) / 2)
        rising = law(np.minimum(middle + 1, c - 1)) > law(middle)
        low, high = np.where(rising & (low < high), middle + 1, low), np.where(rising, high, middle)
        high = np.maximum(low, high)
    far = np.maximum(1, np.ceil(np.sqrt(low) / 2))
    left, right = np.maximum(1, low - far), np.minimum(c - 1, low + far)
    bend = 2 * law(low) - law(left) - law(right)
    width = 1.2 * far / np.sqrt(np.maximum(bend, 1e-3))
    now = np.where(before > 0, before, low)
    return _steps(
        law, c, now, lambda: np.rint(low + width * draw.standard_normal(len(c))), lambda t: -(((t - low) / width) ** 2) / 2, draw
    )


def draw_tables(
    customers: np.ndarray,
    others: np.ndarray,
    chance: np.ndarray,
    discount: float,
    strength: float,
    draw: np.random.Generator,
    before: np.ndarray | None = None,
) -> np.ndarray:
    """Tables of dishes with ``customers`` each (none: none), given ``others`` and ``chance``; ``before``: of the last sweep.

    Discount and chance lie between 0 and 1, both excluded.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    order = np.flatnonzero(customers > 1)  # the others have no choice
    order = order[np.argsort(customers[order], kind="stable")]
    ordered = customers[order]
    others, chance = others[order].astype(float), np.maximum(chance[order].astype(float), 1e-300)
    first = np.flatnonzero(np.diff(ordered, prepend=0))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(ordered)]):
        if ordered[a] <= TABULATED:
            tables[order[a:b]] = _tabulated(int(ordered[a]), others[a:b], chance[a:b], discount, strength, draw)
    at = np.searchsorted(ordered, TABULATED, "right")
    if at < len(ordered):
        held = np.zeros(len(ordered) - at) if before is None else before[order[at:]].astype(float)
        tables[order[at:]] = _proposed(ordered[at:].astype(float), others[at:], chance[at:], held, discount, strength, draw)
    return tables
