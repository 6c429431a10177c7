"""Queries without SQL read their whole table: against NumPy over all rows."""

from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from rasterloom.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def bands():
    table = pq.read_table(f"{SF}/embeddings.parquet").sort_by("vec_id")
    whole = np.array(table["embedding"].to_pylist(), dtype=np.float32).astype(float)
    return whole[:, :32], whole[:, 32:]


def test_pixel_em_reads_all_rows(spark, bands):
    x = np.stack([b.ravel() for b in bands], axis=1)
    p = np.eye(3)[np.digitize(x[:, 0], (-0.05, 0.05))]
    before = None
    for step in range(6):
        n = p.sum(axis=0)
        prior, mean = n / n.sum(), p.T @ x / n[:, None]
        if step and before is not None and np.abs(mean - before).max() <= 1e-4:
            break
        before = mean if step else None
        cov = np.einsum("ik,ia,ib->kab", p, x, x) / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
        away = x[:, None, :] - mean
        score = np.log(prior) - 0.5 * np.log(np.linalg.det(cov)) - 0.5 * np.einsum("ika,kab,ikb->ik", away, np.linalg.inv(cov), away)
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
    found = sorted(tuple(r) for r in catalog.queries()["pixel_em"](spark, SF).collect())
    assert np.allclose([r[1:] for r in found], np.column_stack([prior, mean]), atol=1.01e-4)


def test_region_kmeans_reads_all_rows(spark, bands):
    blocks = [(bands[0][r : r + 7, c : c + 7], bands[1][r : r + 7, c : c + 7]) for r in range(0, len(bands[0]), 8) for c in range(0, 32, 8)]
    points = np.array([[a.mean(), b.mean()] for a, b in blocks])
    n = np.array([a.size for a, _ in blocks])
    ordered = np.sort(points[:, 0])
    centres = np.array([[ordered[int(np.ceil((2 * i + 1) / 6 * len(ordered))) - 1], points[:, 1].mean()] for i in range(3)])
    before = float("inf")
    for _ in range(50):
        away = ((points[:, None] - centres) ** 2).sum(axis=2)
        own = away.argmin(axis=1)
        centres = np.array([np.average(points[own == k], axis=0, weights=n[own == k]) for k in range(3)])
        now = (away.min(axis=1) * n).sum()
        if before - now <= 1e-6 * now:
            break
        before = now
    found = sorted(tuple(r) for r in catalog.queries()["region_kmeans"](spark, SF).collect())
    assert np.allclose([r[1:] for r in found], centres, atol=2e-6)


def test_components_of_the_whole_raster(spark, bands):
    whole = np.concatenate(bands, axis=1)
    classes = np.digitize(whole, (-0.05, 0.05))
    name = np.full(classes.shape, -1)
    for r, c in np.ndindex(*classes.shape):
        todo = [(r, c)] if name[r, c] < 0 else []
        own = r * 2**31 + c
        while todo:
            y, x = todo.pop()
            if 0 <= y < len(classes) and 0 <= x < 64 and name[y, x] < 0 and classes[y, x] == classes[r, c]:
                name[y, x] = own
                todo += [(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    found = catalog.queries()["connected_components"](spark, SF).collect()
    assert len(found) == classes.size and all(r["component"] == name[r["row"], r["col"]] for r in found)
