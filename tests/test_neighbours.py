"""Exact nearest neighbours and SMOTE against brute force: spread, clustered, tied, repeated and tiny tables."""

import numpy as np
import pytest

from veritab.operators import neighbours, sampling


def brute(rows, k):
    out = []
    for key, x in rows:
        others = sorted((round(float(((np.array(x) - np.array(y)) ** 2).sum()), 9), other) for other, y in rows if other != key)
        out += [(key, i, other, d2) for i, (d2, other) in enumerate(others[:k])]
    return sorted(out)


def tables():
    rnd = np.random.default_rng(5)
    clustered = rnd.normal(size=(12, 4))[rnd.integers(0, 12, 500)] * 9 + rnd.normal(size=(500, 4)) * 0.3
    ties = rnd.integers(0, 3, (300, 3)).astype(float)
    copies = np.concatenate([np.ones((150, 2)), rnd.normal(size=(90, 2))])
    return {"clustered": clustered, "ties": ties, "copies": copies, "three": np.eye(3), "one": np.ones((1, 2))}


@pytest.mark.parametrize("name", tables())
def test_equals_brute_force(spark, monkeypatch, name):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "VISITORS", 64)
    rows = [(f"k{i:04d}", [float(v) for v in x]) for i, x in enumerate(tables()[name])]
    frame = spark.createDataFrame(rows, "key string, vec array<double>").repartition(3)
    got = sorted((r["key"], r["place"], r["neighbour"], round(r["d2"], 9)) for r in neighbours.nearest(frame, 3).collect())
    assert [g[:3] for g in got] == [b[:3] for b in brute(rows, 3)]
    assert np.allclose([g[3] for g in got], [b[3] for b in brute(rows, 3)])


def test_far_fewer_pairs_than_all(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    x = tables()["clustered"]
    compared = []
    points = spark.createDataFrame([(i, [float(v) for v in r], [i]) for i, r in enumerate(x)], "point long, vec array<double>, keys array<long>")
    pivots = x[:22].astype(float)
    cells = neighbours._assigned(points, pivots).toPandas()
    radii = cells.groupby("cell")["far"].max().reindex(range(22), fill_value=-1.0).to_numpy()
    third = np.sort(neighbours._distances(x, x), axis=1)[:, 3]
    bounded = spark.createDataFrame(cells.assign(bound=third * 1.5))
    visits = neighbours._visits(bounded, pivots, radii).toPandas()
    for _, v in visits.iterrows():
        own = cells[cells["cell"] == v["cell"]]
        compared.append(int(((own["far"] >= v["near"]) & (own["far"] <= v["beyond"])).sum()))
    assert sum(compared) < 0.2 * len(x) ** 2


def test_empty(spark):
    assert neighbours.nearest(spark.createDataFrame([], "key long, vec array<double>"), 3).collect() == []


def test_smote_fills_the_minority_between_neighbours(spark):
    rnd = np.random.default_rng(2)
    rows = [(f"k{i:03d}", int(i % 6 == 0), [float(v) for v in rnd.normal(size=3)]) for i in range(180)]
    frame = spark.createDataFrame(rows, "key string, label int, vec array<double>")
    got = sampling.smote(frame, "label", "key", "vec").collect()
    assert sum(r["label"] == 1 for r in got) == sum(r["label"] == 0 for r in got) == 150
    near = {}
    for key, _, other, _ in brute([(k, v) for k, y, v in rows if y], 3):
        near.setdefault(key, set()).add(other)
    vec = {k: np.array(v) for k, _, v in rows}
    made = [r for r in got if r["copy_id"]]
    assert len({r["copy_id"] for r in made}) == 120
    for r in made:
        assert r["neighbour"] in near[r["key"]] and 0 <= r["u"] < 1
        assert np.allclose(r["vec"], vec[r["key"]] + r["u"] * (vec[r["neighbour"]] - vec[r["key"]]))
    alone = spark.createDataFrame([("a", 1, [1.0]), ("b", 0, [2.0]), ("c", 0, [3.0])], "key string, label int, vec array<double>")
    assert [r["vec"] for r in sampling.smote(alone, "label", "key", "vec").where("copy_id > 0").collect()] == [[1.0]]
