"""Searches, density clusters and linkage in blocks against plain versions over whole matrices."""

import numpy as np
import pytest

from weekloom.operators import blocked, density, kmeans, percentiles, similar


def vectors_of(n, seed, dim=4, repeats=True):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim)) * 4
    x = np.round(centres[rng.integers(0, 5, n)] + rng.normal(size=(n, dim)) * rng.choice([0.3, 1.5], (n, 1)), 3)
    if repeats:
        x[rng.integers(0, n, n // 10)] = x[rng.integers(0, n, n // 10)]
    return x


def plain_hdbscan(x, least, samples):
    """By cutting the whole graph at every distance, from the largest down; no tree is used."""
    n = len(x)
    far = np.round(np.linalg.norm(x[:, None] - x[None], axis=2), blocked.PLACES)
    np.fill_diagonal(far, np.inf)
    core = np.sort(far, axis=1)[:, min(samples, n - 1) - 1] if n > 1 else np.zeros(n)
    reach = np.maximum(far, np.maximum(core[:, None], core[None, :]))
    np.fill_diagonal(reach, np.inf)

    def parts(rows, below):
        rows, out = np.array(rows), []
        near, left = reach[np.ix_(rows, rows)] < below, np.ones(len(rows), bool)
        while left.any():
            seen = np.zeros(len(rows), bool)
            front = np.array([np.flatnonzero(left)[0]])
            while len(front):
                seen[front] = True
                front = np.flatnonzero(near[front].any(axis=0) & ~seen)
            out.append(rows[seen].tolist())
            left &= ~seen
        return out

    def widest(rows):
        """The largest distance below which the rows hang together no more."""
        steps = np.unique(reach[np.ix_(rows, rows)])
        steps = steps[steps < np.inf]
        low, high = 0, len(steps)  # below steps[low] they are cut, below steps[high] they aren't
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if len(parts(rows, steps[mid])) > 1 else (low, mid)
        return steps[low] if len(steps) and len(parts(rows, steps[low])) > 1 else None

    clusters = []  # rows, stability, parent

    def grow(rows, born, above):
        own = len(clusters)
        clusters.append([rows, 0.0, above])
        now, mass = rows, 0.0
        while True:
            cut = widest(now)
            if cut is None:
                break
            density_ = 1 / max(cut, density.LEAST_DISTANCE)
            split = parts(now, cut)
            big = [p for p in split if len(p) >= least]
            if len(big) == 1:
                mass += density_ * (len(now) - len(big[0]))
                now = big[0]
                continue
            mass += density_ * len(now)
            for p in big:
                grow(p, density_, own)
            break
        clusters[own][1] = mass - born * len(rows)

    if n < least:
        return [-1] * n
    # Groups that no distance holds together can't occur: all pairs are edges.
    grow(list(range(n)), 0.0, None)
    best, take = {}, {}
    for c in range(len(clusters) - 1, -1, -1):
        below = sum(best[k] for k in range(len(clusters)) if clusters[k][2] == c)
        inner = any(clusters[k][2] == c for k in range(len(clusters)))
        take[c] = clusters[c][2] is not None and (not inner or clusters[c][1] >= below)
        best[c] = clusters[c][1] if take[c] else below
    label = [-1] * n
    for c in range(len(clusters)):
        over, above = False, clusters[c][2]
        while above is not None:
            over |= take[above]
            above = clusters[above][2]
        if take[c] and not over:
            for r in clusters[c][0]:
                label[r] = c
    seen = {}
    return [-1 if v < 0 else seen.setdefault(v, len(seen)) for v in label]


@pytest.mark.parametrize(("n", "least", "samples", "seed"), [(90, 5, 1, 1), (120, 8, 3, 2), (60, 3, 2, 3), (4, 5, 1, 4), (1, 2, 1, 5)])
def test_density_clusters_equal_whole_matrix(spark, n, least, samples, seed):
    rows = [("a", k * 7 + 3, v.tolist()) for k, v in enumerate(vectors_of(n, seed))] + [("b", k * 7 + 4, v.tolist()) for k, v in enumerate(vectors_of(30, seed + 50))]
    rows += [("a", 100_001, None), ("a", None, [1.0] * 4), ("b", 100_003, [float("nan")] * 4)]
    df = spark.createDataFrame(rows, "week string, id long, e array<double>")
    got = {(r.week, r.id): r.cluster_id for r in density.clusters(df, ["week"], "e", least, samples, block=16).collect()}
    for week, size, at, s in (("a", n, 3, seed), ("b", 30, 4, seed + 50)):
        want = plain_hdbscan(vectors_of(size, s), least, samples)
        assert [got[week, k * 7 + at] for k in range(size)] == want
    assert len(got) == n + 30


def test_density_clusters_of_500(spark):
    x = vectors_of(500, 9)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, e array<double>")
    got = {r.id: r.cluster_id for r in density.clusters(df, [], "e", 6, 2, block=64).collect()}
    assert [got[k] for k in range(500)] == plain_hdbscan(x, 6, 2)


@pytest.mark.parametrize("block", [7, 1000])
def test_nearest_equals_all_scores(spark, block):
    x = vectors_of(70, 3)
    rows = [(f"w{k % 2}", k, v.tolist(), k % 3) for k, v in enumerate(x)] + [("w0", 900, [1.0, 2.0], 0), ("w0", 901, None, 0), (None, 902, [1.0] * 4, 0)]
    df = spark.createDataFrame(rows, "week string, id long, e array<double>, kind int")
    asked = df.where("id % 5 = 0").selectExpr("week", "id", "e", "CASE WHEN id % 2 = 0 THEN kind END AS kind")
    got = sorted((r.query_id, r.rank, r.id) for r in blocked.nearest(df, asked, ["week"], "e", 4, tag="kind", block=block).collect())
    want = []
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 70, 5):
        hits = sorted((-round(float(unit[q] @ unit[k]), 9), k) for k in range(70) if k % 2 == q % 2 and k != q and (q % 2 or k % 3 == q % 3))
        want += [(q, i + 1, k) for i, (_, k) in enumerate(hits[:4])]
    assert got == sorted(want)
    assert blocked.nearest(df.limit(0), asked, ["week"], "e", 4).count() == 0


def test_percentiles_equal_sorted_values(spark):
    rng = np.random.default_rng(8)
    groups = {"a": rng.normal(size=501), "b": np.repeat([1.0, 2.0, 2.0000000001], 50), "c": np.array([7.0]), "d": np.concatenate([rng.normal(size=90) * 1e-12, [1e300, -1e308, 1e308]]), "e": np.zeros(40)}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("a", None), ("b", float("nan")), ("f", None)]
    points = {"low": 0.0, "p10": 0.1, "p50": 0.5, "p93": 0.93, "high": 1.0}
    got = {r.k: r for r in percentiles.percentiles(spark.createDataFrame(rows, "k string, x double"), ["k"], "x", points, bins=4).collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        x = np.sort(x)
        for name, p in points.items():
            at = p * (len(x) - 1)
            low, high = x[int(np.floor(at))], x[int(np.ceil(at))]
            assert np.isclose(got[k][name], low + (high - low) * (at - np.floor(at)), rtol=1e-12, atol=0) or not np.isfinite(high - low)


def test_many_centroids_as_few(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(k, [float(x) for x in rng.normal(size=5)]) for k in range(40)], "id long, e array<double>")
    cents = spark.createDataFrame([(f"c{k:02d}", [float(x) for x in rng.normal(size=5)]) for k in range(30)], "name string, centroid array<double>")
    shown = lambda: sorted((r.id, r.best, round(r.sim, 9), r.runner_up, round(r.margin, 9)) for r in similar.to_centroids(rows, cents, "e", "name").collect())
    want = shown()
    monkeypatch.setattr(similar, "FEW", 10)
    assert shown() == want and len(want) == 40


def test_mini_batches_as_a_plain_loop(spark):
    """The same draws and starts in numpy, one centre after the other."""
    x = vectors_of(300, 21, repeats=False)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + [(900, None), (None, [0.0] * 4)], "id long, e array<double>").repartition(3)
    found, centres = kmeans.clusters(df, "e", 5, starts=2, steps=4, batch=60)
    got = {r.id: (r.cluster_id, round(r.distance, 6)) for r in found.collect()}
    rows = df.where("id IS NOT NULL AND e IS NOT NULL").selectExpr("id", "e AS v")
    runs = []
    for s in range(2):
        c = np.array([r.v for r in rows.selectExpr("v", "id", f"xxhash64(id, {-1 - s}, 0) AS h").orderBy("h", "id").limit(5).collect()])
        given = np.zeros(5)
        for step in range(4):
            batch = np.array([r.v for r in kmeans.drawn(rows, 300, step, 60, 0).collect()])
            own = np.linalg.norm(batch[:, None] - c[None], axis=2).argmin(1)
            for j in set(own.tolist()):
                part = batch[own == j]
                given[j] += len(part)
                c[j] = c[j] + (part.sum(0) - len(part) * c[j]) / given[j]
        runs.append((np.square(np.linalg.norm(x[:, None] - c[None], axis=2).min(1)).sum(), c))
    best = min(runs, key=lambda r: r[0])[1]
    far = np.linalg.norm(x[:, None] - best[None], axis=2)
    sizes = np.bincount(far.argmin(1), minlength=5)
    order = sorted(range(5), key=lambda c: (-sizes[c], c))
    assert np.allclose(centres, best[order])
    assert got == {k: (order.index(int(far[k].argmin())), round(float(far[k].min()), 6)) for k in range(300)}
    assert kmeans.clusters(df.limit(0), "e", 5)[0].count() == 0 and kmeans.clamp(500, 2, 40, 50) == 10 and kmeans.clamp(1, 2, 40, 50) == 1


def test_linkage_in_rounds_ends_in_one_task(spark, monkeypatch):
    """Once few clusters are left, no more rounds over all pairs are made, and the clusters are those of whole linkage."""
    from weekloom.operators import blocked, linkage

    rng = np.random.default_rng(11)
    x = rng.normal(size=(60, 5)) + [2, 0, 0, 0, 0]
    rows = spark.createDataFrame([(k % 2, k, v.tolist(), 1) for k, v in enumerate(x)], "group long, node long, v array<double>, n long")
    rounds, nearest = [], blocked.nearest
    monkeypatch.setattr(blocked, "nearest", lambda *a, **k: rounds.append(1) or nearest(*a, **k))
    found = {r["node"]: r["first"] for r in linkage.in_rounds(rows, 0.3, small=25).collect()}
    for g in (0, 1):
        nodes = np.arange(g, 60, 2)
        label = linkage.average_linkage(x[nodes], 0.3)
        assert [found[n] for n in nodes] == [nodes[label == k].min() for k in label]
    assert len(rounds) == 1
