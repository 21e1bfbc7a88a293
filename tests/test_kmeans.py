"""k-means against a plain version in whole numbers, whatever the partitions and folds."""

import hashlib
import math
import random

import pytest

from tripmill.operators import kmeans

UNIT = kmeans.UNIT


def brute(points, k, seed, restarts, tolerance=1e-4):
    """Centroids in units and the costs of all restarts."""
    rows = [(tuple(math.floor(x * UNIT + 0.5) for x in p), w) for p, w in points]

    def squared(p, c):
        total = 0.0
        for a, b in zip(p, c):
            total += (float(a) - float(b)) * (float(a) - float(b))
        return total

    results = []
    for r in range(seed, seed + restarts):
        centroids = []
        for i in range(k):
            best = None
            for p, w in rows:
                far = min((squared(p, c) for c in centroids), default=math.inf) if i else 1.0
                if far > 0:
                    digest = hashlib.md5(":".join(map(str, (r, i, *p))).encode()).hexdigest()
                    key = (-math.log((int(digest[:8], 16) + 1) / 2**32) / (w * far), p)
                    best = key if best is None else min(best, key)
            if best:
                centroids.append(best[1])
        for _ in range(300):
            sums = [[0] * (len(rows[0][0]) + 1) for _ in centroids]
            for p, w in rows:
                place = min(range(len(centroids)), key=lambda c: (squared(p, centroids[c]), c))
                sums[place] = [a + w * b for a, b in zip(sums[place], (1, *p))]
            new = [tuple(int(abs(x) // s[0]) * (1 if x >= 0 else -1) for x in s[1:]) if s[0] else old for old, s in zip(centroids, sums)]
            moved = max(abs(x - y) for a, b in zip(new, centroids) for x, y in zip(a, b))
            centroids = new
            if moved <= tolerance * UNIT:
                break
        results.append((sum(min(squared(p, c) for c in centroids) * w for p, w in rows), centroids))
    best = min(range(restarts), key=lambda i: (results[i][0], i))
    return [[x / UNIT for x in c] for c in sorted(results[best][1])], [c for c, _ in results]


def cloud(seed, n=160):
    rng = random.Random(seed)
    centres = [(-3.0, 2.5), (4.0, 4.0), (0.0, -5.0), (4.5, 3.0)]
    return list({(round(rng.gauss(x, 1.5), 2), round(rng.gauss(y, 1.5), 2)): rng.randint(1, 9) for x, y in rng.choices(centres, k=n)}.items())


@pytest.mark.parametrize(("seed", "k", "fold"), [(1, 3, 3), (3, 4, 1), (5, 4, 1)])
def test_equals_plain_version(spark, monkeypatch, seed, k, fold):
    points = cloud(seed)
    monkeypatch.setattr(kmeans, "FOLD_ROUNDS", fold)
    folds = []
    inner = kmeans._Fold.__init__

    def counted(self, data, *rest):
        inner(self, data, *rest)
        folds.append(self.loose.count())

    monkeypatch.setattr(kmeans._Fold, "__init__", counted)
    expected, costs = brute(points, k, 42, 4)
    for partitions in (1, 7):
        df = spark.createDataFrame([(*p, float(w)) for p, w in points], "a double, b double, weight double").repartition(partitions)
        found = kmeans.fit(df, ["a", "b"], k, restarts=4)
        assert found.centroids == expected
        assert found.costs == pytest.approx([c / UNIT**2 for c in costs], rel=1e-12) and found.cost == min(found.costs)
    # Folds leave fewer rows to read.
    assert fold > 1 or min(folds) < len(points) / 2, folds


def test_few_and_equal_points(spark):
    one = spark.createDataFrame([(1.5, 3.0)], "a double, weight double")
    assert kmeans.fit(one, ["a"], 3, restarts=2).centroids == [[1.5]]
    two = spark.createDataFrame([(1.5, 3.0), (-2.5, 1.0)], "a double, weight double")
    found = kmeans.fit(two, ["a"], 2, restarts=2)
    assert found.centroids == [[-2.5], [1.5]] and found.cost == 0
    assert kmeans.fit(one.limit(0), ["a"], 2).centroids == []
