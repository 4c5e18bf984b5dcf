"""The law of the tables, and the whole model against a sampler that seats customers one by one."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from threadloom.llm import pitman_yor, seating


def partitions(customers):
    """All ways to part numbered customers into tables, as sizes."""
    if customers == 1:
        yield (1,)
        return
    for sizes in partitions(customers - 1):
        yield (*sizes, 1)
        for k in range(len(sizes)):
            yield (*sizes[:k], sizes[k] + 1, *sizes[k + 1 :])


def exact_odds(customers, others, chance, discount, strength):
    """P(t) from all seatings: tables opened one after another, then filled."""
    odds = np.zeros(customers + 1)
    for sizes in partitions(customers):
        weight = math.prod(chance * (strength + discount * (others + k)) for k in range(len(sizes)))
        odds[len(sizes)] += weight * math.prod(j - discount for size in sizes for j in range(1, size))
    return odds / odds.sum()


@pytest.mark.parametrize(("discount", "strength", "others", "chance"), [(0.8, 2.0, 0, 0.3), (0.5, 0.7, 3, 0.05), (0.7, 10.0, 40, 0.4)])
def test_draws_follow_all_seatings(discount, strength, others, chance):
    n, draw = 60_000, np.random.default_rng(1)
    for customers in (1, 2, 3, 5, 8):
        drawn = seating.draw_tables(np.full(n, customers), np.full(n, others), np.full(n, chance), discount, strength, draw)
        found = np.bincount(drawn, minlength=customers + 1) / n
        assert np.abs(found - exact_odds(customers, others, chance, discount, strength)).max() < 0.01
    mixed = np.array([0, 3, 1, 0, 2])
    drawn = seating.draw_tables(mixed, np.zeros(5), np.full(5, 0.5), discount, strength, draw)
    assert ((drawn >= np.minimum(mixed, 1)) & (drawn <= mixed)).all()


def stirling_rows(discount, wanted):
    """log S(c, t) by the recurrence."""
    row, out = np.array([-np.inf, 0.0]), {}
    for c in range(1, max(wanted)):
        t = np.arange(c + 1)
        row = np.logaddexp(np.append(np.log(c - t * discount) + row, -np.inf), np.append(-np.inf, row))
        if c + 1 in wanted:
            out[c + 1] = row
    return out


def test_stirling_numbers_beyond_the_table():
    """What counts are steps from one number of tables to the next."""
    for discount in (0.5, 0.7, 0.8):
        rows = stirling_rows(discount, {3, 1024, 1025, 2500})
        assert np.allclose(seating.table(discount)[3, 1:4], rows[3][1:]) and np.allclose(seating.table(discount)[1024, 1:], rows[1024][1:])
        for c in (1025, 2500):
            t = np.arange(1, c)
            found = seating.log_stirling(np.full(c - 1, c), t, discount)
            near = t <= seating.SUMMED * c**discount
            assert np.abs(found - rows[c][1:c])[near].max() < 1e-6
            middle = t < 0.9 * c
            assert np.abs(np.diff(found - rows[c][1:c]))[middle[1:]].max() < 2e-3


@pytest.mark.parametrize("discount", [0.5, 0.8])
def test_means_at_every_number_of_customers(discount):
    """With a fixed weight of a new table, means within one in a hundred of the exact ones."""
    counts = [8, 9, 20, 100, 1000, 1025, 2000]
    rows, n, draw, far = stirling_rows(discount, set(counts)), 40_000, np.random.default_rng(2), 1e8
    for customers in counts:
        for weight in (0.5, 5.0, 50.0):
            t = np.arange(1, customers + 1)
            odds = rows[customers][1:] + t * math.log(weight)
            odds = np.exp(odds - odds.max())
            mean = (odds * t).sum() / odds.sum()
            size = n if customers <= seating.TABULATED else 10_000
            chance = np.full(size, weight / (discount * far))
            drawn = None
            for _ in range(1 if customers <= seating.TABULATED else 4):
                drawn = seating.draw_tables(np.full(size, customers), np.full(size, far), chance, discount, 2.0, draw, drawn)
            error = math.sqrt((odds * (t - mean) ** 2).sum() / odds.sum() / size)
            assert abs(drawn.mean() - mean) < 0.01 * mean + 4 * error, (customers, weight, mean, drawn.mean())


def plain_gibbs(texts, shape, sweeps, burn, seed):
    """log10 P(text) of all texts under the mean probabilities; customers are seated one by one."""
    draw = random.Random(seed)
    tokens = [[*text.lower().split(), "\n"] for text in texts]
    pairs = [(u, w) for line in tokens for u, w in zip(["", *line], line)]
    vocabulary = {w for _, w in pairs}
    v = len(vocabulary)
    tables = defaultdict(list)  # (u, w): sizes; the parent: w
    total, count = Counter(), Counter()  # tables and customers of a restaurant

    def base(w):
        held = sum(tables[w]) - shape.parent_discount * len(tables[w])
        rest = (shape.parent_strength + shape.parent_discount * total[None]) / (v + 1)
        return (held + rest) / (shape.parent_strength + count[None])

    def seat(key, restaurant, discount, strength, below):
        """Returns whether a table was opened."""
        odds = [size - discount for size in tables[key]] + [(strength + discount * total[restaurant]) * below]
        at = draw.choices(range(len(odds)), odds)[0]
        count[restaurant] += 1
        if at == len(tables[key]):
            tables[key].append(1)
            total[restaurant] += 1
            return True
        tables[key][at] += 1
        return False

    def leave(key, restaurant):
        """Returns whether a table was closed."""
        at = draw.choices(range(len(tables[key])), tables[key])[0]
        tables[key][at] -= 1
        count[restaurant] -= 1
        if not tables[key][at]:
            del tables[key][at]
            total[restaurant] -= 1
            return True
        return False

    def enter(u, w):
        if seat((u, w), u, shape.discount, shape.strength, base(w)):
            seat(w, None, shape.parent_discount, shape.parent_strength, 1 / (v + 1))

    for u, w in pairs:
        enter(u, w)
    distinct, sums, samples = sorted(set(pairs)), Counter(), 0
    for sweep in range(sweeps):
        for u, w in pairs:
            if leave((u, w), u):
                leave(w, None)
            enter(u, w)
        if sweep >= burn:
            samples += 1
            for u, w in distinct:
                own = sum(tables[u, w]) - shape.discount * len(tables[u, w])
                sums[u, w] += (own + (shape.strength + shape.discount * total[u]) * base(w)) / (shape.strength + count[u])
    return [sum(math.log10(sums[u, w] / samples) for u, w in zip(["", *line], line)) for line in tokens]


def test_scores_match_a_plain_sampler(spark):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]

    def text():
        out = draw.choices(words, weights, k=draw.randint(1, 30))
        return " ".join(w if draw.random() < 0.6 else f"{out[max(0, k - 1)]}x" for k, w in enumerate(out))

    texts = [text() for _ in range(120)] + ["w0 w1"] * 40  # a pair of forty customers and more
    plain = plain_gibbs(texts, pitman_yor.Shape(), 60, 20, 1)
    df = spark.createDataFrame([(k, t, True) for k, t in enumerate(texts)], "doc_id long, text string, train boolean")
    found = {r["doc_id"]: (r["score"], r["n_tokens"]) for r in pitman_yor.score_documents(df).collect()}
    each = np.array([(found[k][0] - plain[k]) / found[k][1] for k in range(len(texts))])
    assert abs(sum(s for s, _ in found.values()) / sum(plain) - 1) < 0.01
    assert np.abs(each).mean() < 0.02 and abs(each.mean()) < 0.008
