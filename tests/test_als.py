"""ALS by blocks: every half step is exact, whatever the blocks, for short and long rows."""

import numpy as np
import pytest

from tunelake.operators import als
from tunelake.operators import recommend as rc


def exact(y, ratings, reg, alpha):
    """The factors of one row by the dense system; ``ratings``: (place in y, r)."""
    a, b, likes = y.T @ y, np.zeros(y.shape[1]), 0
    for i, r in ratings:
        a += alpha * abs(r) * np.outer(y[i], y[i])
        if r > 0:
            b += (1 + alpha * r) * y[i]
            likes += 1
    return np.linalg.solve(a + reg * likes * np.eye(len(b)), b)


@pytest.mark.parametrize("cells", [als.CELLS, 40])
def test_solved_equals_the_dense_system(monkeypatch, cells):
    monkeypatch.setattr(als, "CELLS", cells)
    rng = np.random.default_rng(1)
    y = rng.normal(size=(40, 6))
    weights, turn = np.linalg.eigh(y.T @ y)
    rows = [[(int(i), float(rng.integers(-1, 9))) for i in rng.choice(40, n, replace=False)] for n in (1, 3, 5, 6, 7, 30, 3, 1)]
    rows.append([(2, -3.0), (4, 0.0)])  # nothing liked
    at = np.array([i for row in rows for i, _ in row], np.int32)
    r = np.array([v for row in rows for _, v in row], np.float32)
    begin = np.cumsum([0] + [len(row) for row in rows[:-1]])
    got = als.solved(y @ turn, begin, at, r, weights, 0.05, 50.0) @ turn.T
    for x, row in zip(got, rows, strict=True):
        assert np.allclose(x, exact(y, row, 0.05, 50.0), atol=1e-8)


@pytest.mark.parametrize("blocks", [1, 4])
def test_users_solve_for_the_items(spark, blocks):
    """The last half step's result is the exact one for the items' factors; repeated pairs count twice."""
    rng = np.random.default_rng(3)
    rows = [(u, int(s), int(rng.integers(1, 6))) for u in range(25) for s in rng.choice(30, 2 + u, replace=False)]
    rows.append(rows[0])
    coded = spark.createDataFrame(rows, "user_idx int, song_idx int, play_count bigint")
    model = rc.fit_als(coded, rank=5, max_iter=2, reg=0.1, alpha=5.0, num_blocks=blocks)
    users = {r.id: np.array(r.features, float) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features, float) for r in model.itemFactors.collect()}
    assert set(users) == set(range(25)) and set(items) == {s for _, s, _ in rows}
    place = {s: i for i, s in enumerate(sorted(items))}
    y = np.array([items[s] for s in sorted(items)])
    for u, x in users.items():
        assert np.allclose(x, exact(y, [(place[s], r) for v, s, r in rows if v == u], 0.1, 5.0), atol=1e-4)


def test_no_ratings_and_nulls_are_refused(spark):
    kind = "user_idx int, song_idx int, play_count bigint"
    for rows in ([], [(1, None, 2)], [(1, 1, None)]):
        with pytest.raises(ValueError):
            rc.fit_als(spark.createDataFrame(rows, kind), rank=2, max_iter=1, num_blocks=2)


def test_blocks_are_solved_in_turns_with_the_same_factors(spark, monkeypatch):
    """What is sent at once is bounded by the factors, not by the interactions."""
    rng = np.random.default_rng(4)
    rows = [(u, int(s), int(rng.integers(1, 6))) for u in range(30) for s in rng.choice(24, 12, replace=False)]
    coded = spark.createDataFrame(rows, "user_idx int, song_idx int, play_count bigint")
    fit = lambda: rc.fit_als(coded, rank=4, max_iter=2, reg=0.1, alpha=5.0, num_blocks=6)
    want = [dict(t.collect()) for m in [fit()] for t in (m.userFactors, m.itemFactors)]
    monkeypatch.setattr(als, "TURN_BYTES", 1)
    turns, rows_sent = [], als._sent
    monkeypatch.setattr(als, "_sent", lambda rank, turn, of: turns.append((turn, of)) or rows_sent(rank, turn, of))
    got = [dict(t.collect()) for m in [fit()] for t in (m.userFactors, m.itemFactors)]
    assert min(of for _, of in turns) > 1 and {t for t, of in turns} == set(range(max(of for _, of in turns)))
    for a, b in zip(got, want, strict=True):
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], atol=1e-5) for i in a)
