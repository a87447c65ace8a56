"""Operator 11 (importance resampling), against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return len(words), [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, n=1, least_words=20, percent=10, buckets=10_000, seed=2024):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    made = [(d, *features(t, n)) for d, t in docs]
    s = Counter(bucket(f) for _, _, fs in made for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x, n)[1])
    total_s, total_t, rows = sum(s.values()), sum(t.values()), []
    for d, words, fs in made:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in map(bucket, fs)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, words >= least_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def check(docs, target, **options):
    got = importance.resample(docs, target, **options)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    rows, aims = [tuple(r) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in target.collect()]
    names = {"ngram": "n"}
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, aims, **{names.get(k, k): v for k, v in options.items()})


@pytest.mark.parametrize("ngram", [1, 3])
def test_documents(spark, ngram, monkeypatch):
    monkeypatch.setattr(importance, "DIGIT_BITS", 5)  # more passes
    monkeypatch.setattr(importance, "LEAST_BLOCK", 4)  # more blocks
    monkeypatch.setattr(importance, "SLICE", 50)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    check(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"), ngram=ngram)


def test_odd_rows(spark, odd_docs, no_docs):
    """Nulls, empty and long texts, clashing columns; no target; no documents; no eligible document."""
    target = spark.createDataFrame([("the quick brown fox école 日本語 WORD1",), (None,), ("",)], "text string")
    check(odd_docs, target, percent=50)
    check(odd_docs, target.where("false"), percent=100, least_words=0)
    check(odd_docs, target, least_words=10 ** 6)
    assert importance.resample(no_docs, target).count() == 0


def test_ties_and_wide_ids(spark, monkeypatch):
    """Scores that all tie, ids over the whole range of a long, null and repeated ids."""
    monkeypatch.setattr(importance, "LEAST_BLOCK", 3)
    monkeypatch.setattr(importance, "gumbel", lambda doc_id, seed: 0)
    text = " ".join(f"w{i}" for i in range(25))
    ids = [2 ** 63 - 1, -2 ** 63, 0, -1, 1, None, 7, 7, *range(100, 160)]
    docs = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string").repartition(3)
    got = importance.resample(docs, docs.select("text").limit(1), percent=100).collect()
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"])]
    assert order == sorted((i for i in ids if i is not None)) + [None]
    assert sorted(r["rank"] for r in got) == list(range(1, len(ids) + 1))


def test_radix_order(spark):
    rng = np.random.default_rng(3)
    rows = [(int(a), int(b)) for a, b in zip(rng.integers(-50, 50, 3000), rng.permutation(3000))]
    df = spark.createDataFrame([(b, a, 0, 0) for a, b in rows], "doc_id long, score long, n_features long, weight long").repartition(7)
    got = importance.radix_ranked(df, importance.rank_fields(df), len(rows)).collect()
    assert sorted(r["at"] for r in got) == list(range(3000))
    assert [(r["score"], r["doc_id"]) for r in sorted(got, key=lambda r: r["at"])] == sorted(rows, key=lambda r: (-r[0], r[1]))


def test_a_pass_plans_no_window_over_rows(spark):
    df = spark.range(1000).selectExpr("id AS at", "id % 7 AS key")
    plan = importance.counting_pass(df, importance.F.col("key"), 6)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("sum(n" in line for line in windows)
