"""Operator 10 (exact top-k search)."""

from collections import defaultdict

import numpy as np

from tests.conftest import SF_SMALL
from tidemark.llm import topk_search


def brute(rows, k=10, every=100):
    usable = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    asking = {}
    for i, v in sorted(usable, key=lambda r: (r[0], r[1])):
        if i % every == 0:
            asking.setdefault(i, v)
    out = []
    for q, mine in asking.items():
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in usable if i != q and len(v) == len(mine))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def check(df):
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, topk_search.top_k(df).collect())) == brute(rows)


def test_embeddings(spark):
    check(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))


def test_ties_nulls_lengths_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "x") for i in range(300)]
    same = [0.5] * 8
    rows += [(i, same, "x") for i in range(1000, 1400)]           # ties beyond k, one a query
    rows += [(5, same, "x"), (5, same, "x"), (100, rows[100][1], "x")]  # repeated ids
    rows += [(2000, None, "x"), (2100, [1.0, None] + same[2:], "x"), (2200, [float("nan")] * 8, "x"),
             (2300, [float("inf")] * 8, "x"), (2400, [], "x"), (None, same, "x"), (2500, [1.0, 2.0], "x"), (2501, [3.0, -1.0], "x"),
             (-100, [-x for x in same], "x"), (2600, [1.0, 2.0, 3.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(5)
    check(df)
    assert topk_search.top_k(df.where("false")).count() == 0


def test_blocks_of_queries(spark, monkeypatch):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    monkeypatch.setattr(topk_search, "BLOCK_VALUES", 100)
    check(df)


def test_large_components_stay_exact():
    rows = [np.array([3e9, 1.0, -2.0]), np.array([2e9, 0.5, 4.0])]
    ints = topk_search.as_integers(rows)
    assert ints.dtype == object and int(ints[0] @ ints[1]) == (3072 * 10 ** 9) * (2048 * 10 ** 9) + 1024 * 512 - 2048 * 4096


def test_bounds_hold():
    rng = np.random.default_rng(7)
    a, b = rng.integers(-2000, 2000, (40, 64)), rng.integers(-2000, 2000, (50, 64))
    exact, last = a @ b.T, None
    for segments in topk_search.LEVELS:
        bound = topk_search.segment_features(a, segments) @ topk_search.segment_features(b, segments).T
        assert (bound >= exact - 1e-3).all()
        assert last is None or (bound <= last + 1e-3).all()
        last = bound
    found = defaultdict(list)
    search = topk_search.BlockSearch(np.arange(40), a, 5)
    search.add(np.arange(1000, 1050), b)
    for q, (scores, ids) in enumerate(search.best):
        found[q] = list(zip(scores.tolist(), ids.tolist()))
        assert found[q] == sorted(zip(exact[q].tolist(), range(1000, 1050)), key=lambda x: (-x[0], x[1]))[:5]


def test_blocks_are_released(spark, monkeypatch):
    live, most = [0], [0]
    make = spark.sparkContext.broadcast

    def counted(value):
        sent = make(value)
        live[0] += 1
        most[0] = max(most[0], live[0])
        free = sent.destroy

        def destroy(*args):
            live[0] -= 1
            free(*args)
        sent.destroy = destroy
        return sent

    monkeypatch.setattr(topk_search, "BLOCK_VALUES", 200)
    monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").limit(400)
    assert topk_search.top_k(rows).count() > 0 and most[0] == 1 and live[0] == 0
