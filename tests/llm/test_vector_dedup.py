import numpy as np
import pytest

from lexigraph.llm import vector_dedup as V


def brute(rows, threshold=0.9):
    ids, matrix = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in np.argwhere(linked):
        a, b = find(ids[a]), find(ids[b])
        root[max(a, b)] = min(a, b)
    return {i: (int(n), find(i)) for i, n in zip(ids, linked.sum(axis=1))}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


@pytest.fixture(scope="module")
def clustered(spark):
    """Groups of near copies, exact copies among them, beside unrelated vectors."""
    rng = np.random.default_rng(5)
    rows = []
    for size, noise in ((300, 0.25), (40, 0.3), (5, 0.1), (200, 5.0)):
        centre = rng.normal(size=48)
        rows += [np.float32(centre + noise * rng.normal(size=48)) for _ in range(size)]
    rows += rows[:7] + [rows[300]] * 30
    return spark.createDataFrame([(i * 3, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id BIGINT, embedding ARRAY<FLOAT>")


@pytest.mark.parametrize("block", [60, V.BLOCK])
def test_links_and_recall(clustered, block):
    want, got = brute([(r.vec_id, r.embedding) for r in clustered.collect()]), result(V.near_duplicates(clustered, block=block))
    assert set(want) == set(got)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_estimates_are_unbiased_and_bounds_hold():
    rng, dim = np.random.default_rng(2), 128
    a, b = rng.normal(size=(2, dim))
    a /= np.linalg.norm(a)
    b = 0.8 * a + 0.6 * (b - (a @ b) * a) / np.linalg.norm(b - (a @ b) * a)
    found = []
    for seed in range(300):
        turn = V.Rotations(dim, 1, seed).first
        x, y = a @ turn, b @ turn
        code, factor = np.sign(x) / np.sqrt(dim), np.abs(x).sum() / np.sqrt(dim)
        estimate = code @ y / factor
        assert abs(estimate - 0.8) <= V.EPSILON * np.sqrt((1 - factor**2) / factor**2 / (dim - 1))
        found.append(estimate)
    assert abs(np.mean(found) - 0.8) < 4 * np.std(found) / np.sqrt(len(found))


def test_tables_reach_the_recall():
    for n in (0, 1, 500, 10**5, 10**9):
        bits, tables = V.plan_tables(n)
        agree = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - agree) ** tables >= V.RECALL and 8 <= bits <= 30


def test_odd_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0]), (7, [2.0]), (8, [1.0, 0.0])]
    rows += [(None, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [3.0, 0.0]), (11, [float("inf"), 1.0]), (12, [-1.0, 0.0])]
    df = spark.createDataFrame([r + (1, "x") for r in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, n INT, vec STRING")
    alone = {i: (0, i) for i in (1, 2, 3, 4, 5, 11, 12, None)}
    assert result(V.near_duplicates(df)) == alone | {6: (1, 6), 7: (1, 6), 8: (2, 8), 9: (2, 8), 10: (2, 8)}
    assert V.near_duplicates(df.filter("false")).collect() == []


def test_any_magnitude(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(2, 32))
    near = a + 0.05 * rng.normal(size=32)
    vectors = [a * 1e-200, near * 1e200, a * 1e-200, b * 1e-300, b * 2.0**900, [5e-324] + [0.0] * 31, [1.0] + [0.0] * 31, -a * 1e150]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    want = {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5), 7: (0, 7)}
    assert result(V.near_duplicates(df)) == want


def test_vectors_are_packed_without_loss():
    rng = np.random.default_rng(3)
    single = rng.normal(size=(5, 9)).astype(np.float32).astype(float)
    double = rng.normal(size=(5, 9))
    small = np.full((1, 9), 5e-324)
    raw = [V.packed(v) for v in (*single, *double, *small)]
    assert [r[:1] for r in raw] == [b"f"] * 5 + [b"d"] * 6
    assert (V.unpacked(raw) == np.vstack([single, double, small])).all()


@pytest.mark.parametrize("tables,bits", [(0, 8), (1, 8), (7, 13), (40, 30)])
def test_keys_come_from_a_prefix_of_the_signs(tables, bits):
    signs = np.random.default_rng(4).integers(0, 2, (600, 40 * 30), dtype=np.uint8)
    cut = np.packbits(signs, axis=1)[:, : -(-tables * bits // 8)]
    want = [[sum(int(b) << k for k, b in enumerate(row[t * bits : (t + 1) * bits])) for t in range(tables)] for row in signs]
    assert V.table_keys(cut, tables, bits).tolist() == want


def test_scaling_is_exact():
    rng = np.random.default_rng(1)
    for size in (1e-200, 1e-30, 1.0, 3e100):
        v = rng.normal(size=8) * size
        got = V.scaled(v)
        assert 0.5 <= np.abs(got).max() < 1
        ratio = got / v
        assert (ratio == ratio[0]).all() and np.frexp(ratio[0])[0] == 0.5
