import numpy as np
import pytest

from ledgerlens.llm import embeddings
from ledgerlens.llm.common import Workspace

ODD = [None, [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [], [1.0, 2.0], [1.0, 2.0]]


def table(spark, vectors, odd=ODD):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(len(vectors) + i, v) for i, v in enumerate(odd)] + ([(None, [float(x) for x in vectors[0]])] if len(vectors) else [])
    return spark.createDataFrame([(*row, 1, True) for row in rows], "vec_id long, embedding array<float>, links long, kept boolean")


def planted(n=1500, width=16, seed=1):
    rng = np.random.default_rng(seed)
    vectors = rng.standard_normal((n, width))
    for i in range(n // 2, n // 2 + 200):
        base = vectors[i - n // 2] / np.linalg.norm(vectors[i - n // 2])
        off = rng.standard_normal(width)
        off -= off @ base * base
        cosine = rng.uniform(0.93, 0.99)
        vectors[i] = cosine * base + np.sqrt(1 - cosine**2) * off / np.linalg.norm(off)
    vectors[1000:1300] = vectors[3] + 0.1 * rng.standard_normal((300, width))
    vectors[1300:1340] = vectors[5]
    vectors[1340] = 3 * vectors[6]
    return vectors.astype(np.float32)


def brute_force(vectors, threshold=0.95):
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    return near


@pytest.mark.parametrize("tile_rows", [embeddings.TILE_ROWS, 64])
def test_links_against_brute_force(spark, tile_rows, monkeypatch):
    monkeypatch.setattr(embeddings.candidates, "__defaults__", (tile_rows,))
    vectors = planted()
    near = brute_force(vectors)
    rows = {r.vec_id: r for r in embeddings.embedding_links(table(spark, vectors).repartition(4), Workspace(spark, "t")).collect()}
    n = len(vectors)
    want, got = near.sum(axis=1), np.array([rows[i].n_links for i in range(n)])
    # The row without an id is a copy of the first vector, so it counts for its partners.
    want[0] += 1
    want[near[0]] += 1
    assert (got <= want).all()
    assert got.sum() >= 0.97 * want.sum()
    assert got[n // 2 : n // 2 + 200].sum() >= 0.9 * want[n // 2 : n // 2 + 200].sum()
    label = np.arange(n)
    for _ in range(20):
        label = np.minimum(label, np.where(near, label[None, :], n).min(axis=1))
    component = np.array([rows[i].component_id for i in range(n)])
    assert (component >= label).all() and (component == label).mean() > 0.95
    assert all(rows[i].kept == (rows[i].component_id == i) for i in range(n))
    assert [(rows[n + i].n_links, rows[n + i].component_id) for i in range(6)] == [(0, n + i) for i in range(6)]
    assert [(rows[n + i].n_links, rows[n + i].component_id) for i in (6, 7)] == [(1, n + 6)] * 2
    assert rows[None].component_id == rows[0].component_id


def test_empty_and_tiny_tables(spark):
    assert embeddings.embedding_links(table(spark, [], odd=[]), Workspace(spark, "t")).count() == 0
    only_odd = embeddings.embedding_links(table(spark, [], odd=ODD[:6]), Workspace(spark, "t")).collect()
    assert [r.n_links for r in only_odd] == [0] * 6 and all(r.kept for r in only_odd)


def test_rotation_balances_bits():
    rng = np.random.default_rng(3)
    sample = rng.standard_normal((2000, 8)) * [5, 3, 2, 1, 1, 1, 0.5, 0.2] + 4
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    mean, projection = embeddings.learn_rotations(sample, 20)
    assert projection.shape == (8, 20)
    first = projection[:, :8]
    assert np.allclose(first.T @ first, np.eye(8))
    share = ((sample - mean) @ projection > 0).mean(axis=0)
    assert (abs(share - 0.5) < 0.2).all()

    def error(rotated):
        return np.square(np.where(rotated > 0, 1, -1) - rotated / np.abs(rotated).mean()).mean()

    assert error((sample - mean) @ first) < error(sample - mean)


def off_centre(n, width, mean_norm, seed, pairs=500):
    """Unit vectors with a mean of that norm; the last `pairs` are at cosine 0.95 to 0.97 to the first ones."""
    rng = np.random.default_rng(seed)
    mean = rng.standard_normal(width)
    mean *= mean_norm / np.linalg.norm(mean)
    unit = mean + rng.standard_normal((n, width)) * np.sqrt((1 - mean_norm**2) / width)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    base, off = unit[:pairs], rng.standard_normal((pairs, width))
    off -= (off * base).sum(axis=1, keepdims=True) * base
    cosine = rng.uniform(0.951, 0.97, (pairs, 1))
    unit[n - pairs :] = cosine * base + np.sqrt(1 - cosine**2) * off / np.linalg.norm(off, axis=1, keepdims=True)
    return unit


def test_recall_with_a_large_common_mean_and_two_lengths(spark):
    sets = [off_centre(2500, 64, 0.83, 5), off_centre(1500, 32, 0.9, 6)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([*sets[0], *sets[1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r.n_links for r in embeddings.embedding_links(df, Workspace(spark, "t")).collect()}
    begin = 0
    for vectors in sets:
        want = brute_force(vectors).sum(axis=1)
        got = np.array([found[begin + i] for i in range(len(vectors))])
        print("recall", len(vectors[0]), got.sum() / want.sum(), want.sum())
        assert (got <= want).all() and want.sum() >= 1000
        assert got.sum() >= 0.975 * want.sum()
        begin += len(vectors)


@pytest.mark.parametrize("mean_norm", [0.0, 0.7, 0.83, 0.95])
@pytest.mark.parametrize("rows", [10_000, 10_000_000])
def test_plan_finds_off_centre_pairs(mean_norm, rows):
    vectors = off_centre(6000, 64, mean_norm, 7, pairs=2000)
    quantiser = embeddings.fit(vectors[:4000], rows)
    apart = embeddings.bits_apart(quantiser, (vectors[:2000], vectors[4000:]))
    recall = ((apart.min(axis=1) <= 1) & (apart.sum(axis=1) <= quantiser.most_apart)).mean()
    print("mean", mean_norm, "rows", rows, "recall", recall, "segments", quantiser.segments, "bits", quantiser.bits)
    assert recall >= 0.975
    assert quantiser.segments <= embeddings.MOST_SEGMENTS


@pytest.mark.parametrize("width", [1, 2, 3])
def test_few_components_keep_recall(width):
    rng = np.random.default_rng(width)
    sample = rng.standard_normal((1000, width)) + 1
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    quantiser = embeddings.fit(sample, 1000)
    for pairs in embeddings.threshold_pairs(sample, embeddings.THRESHOLD, seed=9):
        assert (embeddings.bits_apart(quantiser, pairs).min(axis=1) <= 1).mean() >= 0.97
