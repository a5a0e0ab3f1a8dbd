from __future__ import annotations

import math

import numpy as np
import pytest

from lateline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, x string, component int"


def vectors(seed=4, count=300, size=12):
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.normal(size=(size, size)))
    rows = (rng.normal(size=(count, size)) * np.linspace(3, 0.2, size) @ turn + 1).astype(np.float32).tolist()
    out = [(k, row, 7, "y", None) for k, row in enumerate(rows)]
    out += [(900 + k, rows[0], None, None, 1) for k in range(150)] + [out[3]] * 2 + [(None, rows[5], 1, "", 2)]
    bad = [None, [], [None] * size, [math.nan, *rows[0][1:]], [math.inf, *rows[0][1:]], rows[1][:5]]
    return out + [(2000 + k, b, 0, "", 0) for k, b in enumerate(bad)]


def brute(rows, scale=256, components=4):
    size = 12
    good = [r for r in rows if r[1] is not None and len(r[1]) == size and all(c is not None and math.isfinite(c) for c in r[1])]
    whole = [[math.floor(scale * c) for c in r[1]] for r in good]
    fit = sorted(set(map(tuple, whole)))
    n, sums = len(fit), [sum(v[d] for v in fit) for d in range(size)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1][:components], vectors_[:, ::-1][:, :components]
    out = []
    for r, x in zip(good, whole):
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        out += [(r[0], k + 1, n, deviation, float((np.array(x) - mean) @ vectors_[:, k] / math.sqrt(values[k])),
                 values[k] / np.trace(centred.T @ centred / n)) for k in range(len(values))]
    return out


def test_whitening_matches_brute_force(shipped):
    rows = vectors()
    got = whitening.whitened(shipped.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want = brute(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for k in range(1, 5):
        a = np.array([r[4] for r in got if r[1] == k])
        b = np.array([r[4] for r in want if r[1] == k])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
    assert all(abs(a[5] / b[5] - 1) < 1e-12 for a, b in zip(got, want))
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-10


def test_whitening_without_variance_and_of_nothing(shipped):
    one = shipped.createDataFrame([(1, [0.5, -0.0], 1, "", 1), (2, [0.5, 0.0], 1, "", 1)], SCHEMA)
    got = whitening.whitened(one).collect()
    assert len(got) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, None, None)}
    line = shipped.createDataFrame([(k, [float(k), 2.0 * k], 1, "", 1) for k in range(5)], SCHEMA)
    got = whitening.whitened(line).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got)
    assert whitening.whitened(shipped.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whitened(shipped.createDataFrame([(1, None, 1, "", 1)], SCHEMA)).collect() == []


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, 3]])
    assert whitening._deviations(x, 1000, [5, 7]) == [None]
    assert whitening._deviations(np.array([[1 << 20, 3]]), 1000, [5, 7]) == [(1000 * (1 << 20) - 5) ** 2 + 2993 ** 2]


def spectra():
    rng = np.random.default_rng(8)
    turn, _ = np.linalg.qr(rng.normal(size=(24, 24)))
    yield "graded", turn @ np.diag(10.0 ** -np.arange(24)) @ turn.T
    yield "groups", turn @ np.diag([9.0] * 9 + [3.0] * 8 + [0.0] * 7) @ turn.T
    yield "cluster", turn @ np.diag(1 + 1e-10 * np.arange(24)) @ turn.T
    yield "signs", turn @ np.diag(np.linspace(-3, 3, 24)) @ turn.T
    yield "zero", np.zeros((5, 5))
    yield "identity", np.eye(7) * 4
    yield "single", np.array([[2.5]])
    sample = rng.normal(size=(200, 64))
    yield "flat", np.cov(sample.T, bias=True)


@pytest.mark.parametrize("name, matrix", list(spectra()))
def test_components_by_divide_and_conquer(name, matrix):
    values, found = whitening.leading_components(matrix, 4)
    right = np.linalg.eigvalsh(matrix)[::-1][:4]
    top = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(values - right).max() <= 1e-13 * top * len(matrix)
    assert np.abs(found.T @ found - np.eye(found.shape[1])).max() < 1e-13
    assert np.abs(matrix @ found - found * values).max() <= 1e-13 * top * len(matrix)


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(2)
    turn, _ = np.linalg.qr(rng.normal(size=(10, 10)))
    values = np.array([1e-9, -1e-6, 3, -2, 1, 5, -7, 0.1, -0.1, 1e-3])
    got = whitening.polar_factor(turn @ np.diag(values) @ turn.T)
    assert np.abs(got - turn @ np.diag(np.sign(values)) @ turn.T).max() < 1e-6
