from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybeat.llm import vector_links as v
from tests.llm.fixtures import smallest_reachable

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=0.98):
    usable = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1]
              and np.isfinite(r[1]).all() and np.any(r[1])]
    count, links = {id(r): 0 for r in usable}, []
    for a, b in combinations(usable, 2):
        if a[2] == b[2] and len(a[1]) == len(b[1]):
            p, q = (np.array(r[1]) / np.abs(r[1]).max() for r in (a, b))
            if p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= cosine:
                count[id(a)] += 1
                count[id(b)] += 1
                links.append((a[0], b[0]))
    roots = smallest_reachable({r[0] for r in rows if r[0] is not None}, links)
    return sorted([(i, count.get(id(r), 0), roots.get(i), i is None or i == roots[i]) for r in rows for i in [r[0]]], key=str)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("own")).withColumn("kept", F.lit(1))
    return sorted([tuple(r) for r in v.links(df).collect()], key=str)


def clouds(dimensions, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for centre in rng.normal(size=(6, dimensions)):
            for _ in range(15):
                near = centre / np.linalg.norm(centre) + rng.normal(size=dimensions) * 0.11 / dimensions ** 0.5
                rows.append((len(rows), (near * rng.uniform(0.1, 9)).tolist(), label))
    return [rows[k] for k in rng.permutation(len(rows))]


@pytest.mark.parametrize("dimensions", [1, 2, 7, 64])
def test_clouds_equal_brute_force(spark, dimensions):
    rows = clouds(dimensions, dimensions)
    assert found(spark, rows) == brute(rows)


def test_tiles_and_fine_grids_change_nothing(spark, monkeypatch):
    rows = clouds(32, 4)
    want = brute(rows)
    assert sum(r[1] for r in want) > 100
    monkeypatch.setattr(v, "TILE", 5)
    assert found(spark, rows) == want


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    x = [0.6, 0.8]
    rows = [(1, x, 1), (2, x, 1), (3, x, 1), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [None, 1.0], 1), (8, [nan, 1.0], 1),
            (9, [inf, 1.0], 1), (10, x, None), (11, [6e200, 8e200], 1), (12, [6e-200, 8e-200], 1), (13, [0.6, 0.8, 0.0], 1),
            (14, [-0.6, -0.8], 1), (None, x, 1), (15, x, 2), (1, x, 1), (16, [0.0, -0.0, 1.0], 3), (17, [0.0, 0.0, 2.0], 3)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert v.links(spark.createDataFrame([], SCHEMA)).count() == 0
    assert found(spark, [(1, None, 1)]) == [(1, 0, 1, True)]
