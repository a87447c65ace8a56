"""Operator 13 (vector codes by exact products), against a plain version in Python integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import vector_codes


def plain(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [(i, lab, [math.floor(scale * float(x)) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, _, v in kept) // parts))
    kept = [(i, lab, v + [0] * (width * parts - len(v))) for i, lab, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    books = [[v[p * width:(p + 1) * width] for _, _, v in kept[:entries]] for p in range(parts)]

    def best(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, _, v in kept:
            for p in range(parts):
                x = v[p * width:(p + 1) * width]
                members[p, best(x, p)[1]].append(x)
        for (p, e), xs in members.items():
            books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, of_label = [], defaultdict(int)
    for i, lab, v in kept:
        found = [best(v[p * width:(p + 1) * width], p) for p in range(parts)]
        error = sum(d for d, _ in found)
        of_label[lab] += error
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), error))
    return sorted(((i, c, e, of_label[lab], sha) for i, lab, c, e in out), key=repr)


def check(df, **options):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, vector_codes.compress(df, **options).collect()), key=repr)
    assert got == plain(rows, **options)
    return got


SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int"


def test_embeddings(spark):
    check(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").repartition(3))


def test_odd_rows(spark, monkeypatch):
    """Nulls, other lengths, ties, repeated ids, clashing columns, fewer rows than entries, no rows."""
    monkeypatch.setattr(vector_codes, "STEP_ROWS", 17)
    rng = np.random.default_rng(5)
    same = [0.5] * 16
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16)], int(i % 3), "c", 1) for i in range(150)]
    rows += [(i, same, None, "c", 1) for i in range(300, 400)] + [(7, same, 5, "c", 1), (7, same, 5, "c", 1), (None, same, 1, "c", 1)]
    rows += [(500, None, 1, "c", 1), (501, [1.0, None], 1, "c", 1), (502, [float("nan")] * 16, 1, "c", 1),
             (503, [float("-inf")] * 16, 1, "c", 1), (504, [], 1, "c", 1), (505, [1.0, -2.0], None, "c", 1), (506, [0.25] * 19, 9, "c", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    check(df)
    check(df, parts=4, entries=3, rounds=3, scale=10)
    check(df.where("vec_id < 5"))
    assert vector_codes.compress(df.where("false")).count() == 0
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    check(df)


def test_components_beyond_64_bits(spark):
    """Limbs in Python integers; an error that fits no long is null."""
    rows = [(i, [float(np.float32((-1) ** i * 10.0 ** (i % 25))), float(i), -0.1, 3e9], i % 2, "c", 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()], parts=2, entries=8)
    got = sorted(map(tuple, vector_codes.compress(df, parts=2, entries=8).collect()), key=repr)
    assert [(g[0], g[1], g[4]) for g in got] == [(w[0], w[1], w[4]) for w in want]
    assert [g[2] for g in got] == [w[2] if w[2] < 2 ** 63 else None for w in want]


@pytest.mark.parametrize("bits_a, bits_b, inner", [(10, 10, 4), (30, 25, 64), (31, 29, 8), (5, 50, 200), (40, 1, 2048)])
def test_exact_products(bits_a, bits_b, inner):
    rng = np.random.default_rng(bits_a)
    a, b = rng.integers(-2 ** bits_a, 2 ** bits_a, (3, 9, inner)), rng.integers(-2 ** bits_b, 2 ** bits_b, (3, inner, 7))
    want = np.matmul(a.astype(object), b.astype(object))
    assert (vector_codes.exact_product(a.astype(object), b.astype(object)) == want).all()
    if bits_a + bits_b + inner.bit_length() <= 62:
        got = vector_codes.exact_product(a, b)
        assert got.dtype == np.int64 and (got.astype(object) == want).all()
    for x in (a, b):
        bits = (53 - inner.bit_length()) // 2
        parts = vector_codes.limbs(x, bits)
        assert all(np.abs(p).max() <= 2 ** bits for p in parts) and inner * 4 ** bits <= 2 ** 53
        assert (sum(p.astype(np.int64).astype(object) << (bits * i) for i, p in enumerate(parts)) == x).all()
