from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from monthlake.llm import lattice
from monthlake.llm.lattice import cells, near_duplicates, nearest_point

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.93):
    """(vec_id, n_links, component_id, kept) of every row, sorted, by comparing all pairs."""

    def unit(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        w = np.array(v, np.float32).astype(np.float64)
        return w / np.sqrt((w * w).sum())

    units = [unit(v) for _, v, _ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n = [0] * len(rows)
    for i, j in itertools.combinations(range(len(rows)), 2):
        x, y = units[i], units[j]
        if x is None or y is None or len(x) != len(y) or rows[i][2] is None or rows[i][2] != rows[j][2]:
            continue
        if float(x @ y) >= least:
            n[i] += 1
            n[j] += 1
            parent[find(i)] = find(j)
    least_id = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least_id[find(i)] = min(vec_id, least_id.get(find(i), vec_id))
    out = [(r[0], n[i], c := least_id.get(find(i)), r[0] == c) for i, r in enumerate(rows)]
    return sorted(out, key=str)


def ours(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS h", "1 AS node", "2 AS cell")
    return sorted((tuple(r) for r in near_duplicates(df, **settings).collect()), key=str)


def near(rng, centre, cosine):
    """A unit vector at this cosine to a unit vector."""
    w = rng.normal(size=len(centre))
    w -= (w @ centre) * centre
    w /= np.linalg.norm(w)
    return cosine * centre + math.sqrt(1 - cosine * cosine) * w


def unit(rng, length):
    v = rng.normal(size=length)
    return v / np.linalg.norm(v)


def as_floats(v):
    return [float(np.float32(x)) for x in v]


@pytest.fixture(scope="module")
def mixed():
    """Random vectors, copies, tight and loose groups, several labels and lengths."""
    rng = np.random.default_rng(3)
    rows = [(i, as_floats(unit(rng, 64)), i % 3) for i in range(300)]
    tight, loose, short = unit(rng, 64), unit(rng, 64), unit(rng, 5)
    rows += [(300 + i, as_floats(near(rng, tight, 0.995)), 1) for i in range(120)]
    rows += [(420 + i, as_floats(near(rng, loose, 0.97)), 2) for i in range(60)]
    rows += [(480 + i, as_floats(tight), 1) for i in range(40)]
    rows += [(520 + i, as_floats(3 * tight), 1) for i in range(5)]
    rows += [(530 + i, as_floats(near(rng, short, 0.999)), 0) for i in range(20)]
    rows += [(560 + i, as_floats(near(rng, tight, 0.99)), 2) for i in range(10)]
    # Near the rim of the tight group: linked with some of its members only.
    rows += [(580 + i, as_floats(near(rng, tight, 0.93 + 0.004 * i)), 1) for i in range(12)]
    random.Random(1).shuffle(rows)
    return rows


def test_as_by_all_pairs(spark, mixed):
    found, expected = ours(spark, mixed), brute(mixed)
    links, wanted = sum(r[1] for r in found), sum(r[1] for r in expected)
    assert wanted * 0.98 <= links <= wanted
    assert all(f[1] <= e[1] for f, e in zip(sorted(found), sorted(expected), strict=True))
    assert sum(f == e for f, e in zip(found, expected, strict=True)) >= 0.97 * len(mixed)


def test_crowded_cells_and_wide_lattices_give_every_link(spark, mixed):
    """With one cell for all nothing can be missed, whichever way cells are compared."""
    expected = brute(mixed)
    assert ours(spark, mixed, width=1e6, tables=1, probes=1, crowded=10_000) == expected
    assert ours(spark, mixed, width=1e6, tables=1, probes=1, crowded=4) == expected


def test_blocks_of_crowded_cells(spark, mixed, monkeypatch):
    monkeypatch.setattr(lattice, "_BLOCK_ROWS", 64)
    assert ours(spark, mixed, width=1e6, tables=1, probes=1, crowded=4) == brute(mixed)


def test_nothing_below_the_threshold(spark):
    rng = np.random.default_rng(5)
    centres = [unit(rng, 64) for _ in range(200)]
    rows = [(2 * i, as_floats(c), 0) for i, c in enumerate(centres)]
    rows += [(2 * i + 1, as_floats(near(rng, c, 0.929)), 0) for i, c in enumerate(centres)]
    assert all(r[1] == 0 and r[3] for r in ours(spark, rows))


@pytest.mark.parametrize(("cosine", "least"), [(0.9305, 0.93), (0.95, 0.98), (0.98, 0.998)])
def test_recall(spark, cosine, least):
    rng = np.random.default_rng(6)
    centres = [unit(rng, 64) for _ in range(1000)]
    rows = [(2 * i, as_floats(c), 0) for i, c in enumerate(centres)]
    rows += [(2 * i + 1, as_floats(near(rng, c, cosine)), 0) for i, c in enumerate(centres)]
    found = sum(r[1] for r in ours(spark, rows)) / 2000
    assert least <= found <= 1


def test_lattice_points():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 8)) * 2
    points = nearest_point(x)
    twice = np.rint(2 * points)
    assert np.array_equal(twice, 2 * points)
    assert np.all((twice % 2 == twice[:, :1] % 2).all(1)) and np.all(points.sum(1) % 2 == 0)
    # No other point is nearer: not the 240 around, and so (they bound the cell) none at all.
    around = points[:, None] + lattice._NEIGHBOURS
    assert np.all(((x - points) ** 2).sum(1)[:, None] <= ((x[:, None] - around) ** 2).sum(2) + 1e-12)
    assert len(lattice._NEIGHBOURS) == 240


def test_cells_do_not_depend_on_the_batch():
    rng = np.random.default_rng(8)
    x = np.stack([unit(rng, 64) for _ in range(50)])
    whole = cells(x, 2, 2, 3, 2.0)
    assert np.array_equal(whole[10:20], cells(x[10:20], 2, 2, 3, 2.0))
    assert all(len(set(row)) == 4 for table in whole.transpose(1, 0, 2).tolist() for row in table)


def test_awkward(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (1, v, 1), (1, [-1.0, 0.0, 0.0], 1), (2, v, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0, 0.0], 1),
        (6, [1.0, None, 3.0], 1), (7, [float("nan"), 1.0, 1.0], 1), (8, [float("inf"), 1.0, 1.0], 1), (None, v, 1),
        (None, [5.0, -1.0, 2.0], 1), (9, [1e-30, 2e-30, 3e-30], 1), (10, [1e30, 2e30, 3e30], 1), (11, [1.0, 2.0], 1),
        (12, [1.0], 1), (13, [2.0], 1), (14, [-2.0], 1), (15, v * 700, 1), (16, v * 700, 1),
    ]
    rows += [(20 + i, None, None) for i in range(3)]
    assert ours(spark, rows) == sorted((r if r[0] is not None or r[2] is not None else (*r[:3], True) for r in brute(rows)), key=str)


def test_values_that_only_doubles_hold(spark):
    df = spark.createDataFrame([(1, [1e200, 1e200], "a"), (2, [1e-200, 1e-200], "a"), (3, [1e200, -1e200], "a")], "vec_id long, embedding array<double>, label string")
    assert sorted(tuple(r) for r in near_duplicates(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
