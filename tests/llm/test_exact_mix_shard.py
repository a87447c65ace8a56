"""Operators 2 (exact dedup), 4 (mixing) and 7 (sharding)."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import exact_dedup, mixing, sharding


def brute_groups(rows):
    groups = defaultdict(list)
    for at, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((at, doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        order = sorted(members, key=lambda m: (-len(m[2]), m[1] is None, m[1] or 0))
        for m in members:
            out.append((m[1], order[0][1], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return Counter(out), len(groups)


def check_groups(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want, groups = brute_groups(rows)
    got = exact_dedup.exact_groups(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == groups == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    stays = exact_dedup.drop_copies(docs)
    assert stays.columns == docs.columns
    assert Counter(r["doc_id"] for r in stays.collect()) == Counter(r["doc_id"] for r in kept)


def test_exact_groups_odd_rows(odd_docs, no_docs):
    check_groups(odd_docs)
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).count() == 0


def test_exact_groups_hot_group(spark):
    """A group with most of the rows is split over partitions and joined again."""
    rows = [(i, "same  text" if i % 3 else f"text {i}") for i in range(900)] + [(2000, "same \n  text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert exact_dedup.hot_groups(docs).count() == 1
    check_groups(docs)
    assert exact_dedup.exact_groups(docs).where("kept and group_size > 1").first()["doc_id"] == 2000


def test_exact_groups_table(spark):
    check_groups(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def brute_poisson(u, rate):
    k, p = 0, math.exp(-rate)
    c = p
    while c <= u:
        k += 1
        p *= rate / k
        c += p
    return k


def test_mixing_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    size = Counter()
    for r in rows:
        size[r["source"]] += len(r["text"].encode()) + 1
    weights = {s: 1.0 + i for i, s in enumerate(sorted(size)[:-1])}  # the last source weighs nothing
    rate = {s: weights.get(s, 0) / sum(weights.values()) * sum(size.values()) / size[s] for s in size}
    want = Counter()
    for r in rows:
        parts = max(1, math.ceil(rate[r["source"]] / mixing.PART_RATE))
        for j in range(1, parts + 1):
            u = int(hashlib.md5(f"17|{r['doc_id']}|{j}".encode()).hexdigest()[:13], 16) / 16 ** 13
            want[r["doc_id"]] += brute_poisson(u, rate[r["source"]] / parts)
    got = mixing.replicate(docs, weights).collect()
    assert Counter(r["doc_id"] for r in got) == +want
    keys = [r["shuffle_key"] for r in got]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_mixing_draws_tiny_sources_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "x" * 10, "tiny", 0), (1, "y" * 10, "tiny", 0), (None, "z", None, 0), (2, "z", None, 1)]
        + [(10 + i, "w" * 100_000, "large", 2) for i in range(10)], "doc_id long, text string, source string, copies int")
    weights = {"tiny": 1.0, "large": 1.0}
    got = mixing.replicate(docs, weights).groupBy("doc_id", "source", "text").agg(
        F.count("*").alias("n"), F.countDistinct("copy").alias("kinds"), F.max("copy").alias("last"), F.max("copies_").alias("all")).collect()
    tiny = [r for r in got if r["source"] == "tiny"]
    assert len(tiny) == 2 and len({r["n"] for r in tiny}) == 1  # rows that repeat a doc_id share its draw
    assert all(r["n"] == r["kinds"] == r["last"] == r["all"] for r in got)
    rate = 0.5 * (2 * 11 + 2 * 2 + 10 * 100_001) / 22
    parts = math.ceil(rate / mixing.PART_RATE)
    assert parts > 10 * mixing.ROW_PARTS
    draws = [int(hashlib.md5(f"17|1|{j}".encode()).hexdigest()[:13], 16) / 16 ** 13 for j in range(1, parts + 1)]
    assert tiny[0]["n"] == sum(brute_poisson(u, rate / parts) for u in draws)
    whole = {(r["shuffle_key"], r["text"]) for r in mixing.replicate(docs).collect()}
    monkeypatch.setattr(mixing, "ROW_PARTS", 1 << 20)
    assert whole == {(r["shuffle_key"], r["text"]) for r in mixing.replicate(docs).collect()}


def test_mixing_high_rates_and_odd_rows(spark, odd_docs, no_docs):
    many = spark.createDataFrame([(i, "x" * 10, "small" if i < 5 else "large") for i in range(3000)],
                                 "doc_id long, text string, source string")
    copies = mixing.replicate(many, {"small": 1.0, "large": 1.0}).groupBy("source").count().collect()
    total = {r["source"]: r["count"] for r in copies}
    assert abs(total["small"] - 1500) < 200 and abs(total["large"] - 1500) < 200  # rate of small: 300
    out = mixing.replicate(odd_docs, extras=False)
    assert out.columns == odd_docs.columns and out.count() >= 0
    assert mixing.replicate(no_docs).count() == 0


def scalar_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_loop():
    keys = np.random.default_rng(5).integers(-2 ** 63, 2 ** 63, 500)
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [scalar_jump(int(k) % 2 ** 64, n) for k in keys]


def test_shards(spark, odd_docs, no_docs):
    for docs in (odd_docs, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        got = sharding.assign_shards(docs).collect()
        texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
                        for r in docs.collect())
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
            assert r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16 and r["law"] == "key"
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(no_docs).count() == 0
    spread = sharding.assign_shards(spark.range(20000).selectExpr("id AS doc_id", "'x' AS text")).groupBy("shard").count().collect()
    assert len(spread) == 16 and all(abs(r["count"] - 1250) < 200 for r in spread)


def test_write_shards(spark, odd_docs, tmp_path):
    assert sharding.write_shards(odd_docs.drop("shard"), str(tmp_path / "out")) == "shard"
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd_docs.count()
    named = odd_docs.drop("shard").withColumn("Shard", F.lit("kept"))
    name = sharding.write_shards(named, str(tmp_path / "named"))
    again = spark.read.parquet(str(tmp_path / "named"))
    assert name not in named.columns and again.where("Shard = 'kept'").count() == odd_docs.count()
