"""Operator 9 (BagMinHash near-dedup)."""

import random
from collections import Counter, defaultdict

import numpy as np

from tests.conftest import SF_SMALL
from tidemark.llm import near_dup


def bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_similarity(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def brute_classes(rows):
    bags = [bag(t) for _, t in rows]
    where = defaultdict(set)
    for i, b in enumerate(bags):
        for s in b:
            where[s].add(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, b in enumerate(bags):
        for j in {j for s in b for j in where[s] if j < i}:
            if find(i) != find(j) and brute_similarity(b, bags[j]) >= near_dup.SIMILARITY:
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        members[find(i)].append(doc_id)
    return Counter((d, min((x for x in m if x is not None), default=None), len(m)) for m in members.values() for d in m)


def check_classes(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = near_dup.near_classes(docs).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == brute_classes(rows)
    return got


def planted(seed=1):
    """Families of near copies at many distances, chains, and strangers."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(40):
        origin = [rng.choice(words) for _ in range(rng.randint(60, 300))]
        for edits in (0, 1, 2, 3, 5, 8):
            copy = list(origin)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    chain = [rng.choice(words) for _ in range(100)]
    for i in range(12):  # each close to the next, the ends far apart
        chain = list(chain)
        chain[8 * i] = rng.choice(words)
        rows.append(" ".join(chain))
    repeated = "again and again the same few words "
    rows += [repeated * 30, repeated * 33, repeated * 60, repeated * 3]  # bags that differ in weights alone
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_classes_of_planted_copies(spark):
    check_classes(spark.createDataFrame(planted(), "doc_id long, text string"))


def test_large_cluster_of_unequal_copies(spark, monkeypatch):
    """One original, copies at many distances: links that no pivot shows."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    origin = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(260):
        copy = list(origin)
        for at in rng.sample(range(150), rng.randint(0, 9)):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(near_dup, "BLOCK_NODES", 40)
    check_classes(spark.createDataFrame(rows, "doc_id long, text string"))


def test_buckets_whose_ends_fit_no_member(spark, monkeypatch):
    """Linked pairs among texts that only share a passage: buckets of 6 to 50
    members, most of them neither linked nor promising."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(20_000)]
    rows = []
    for size in (6, 9, 20, 50):
        passage = [rng.choice(words) for _ in range(120)]
        for i in range(size):
            own = passage + [rng.choice(words) for _ in range(55)]
            rows.append(" ".join(own))
            if i % 3 == 0:  # linked with the one before, alike to all others
                own[130] = rng.choice(words)
                rows.append(" ".join(own))
    rng.shuffle(rows)
    monkeypatch.setattr(near_dup, "BLOCK_NODES", 7)
    monkeypatch.setattr(near_dup, "FANOUT", 1)
    check_classes(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))


def test_first_step_meets_few(spark):
    """Rows of the first join grow with a group of near copies, not faster, and a node has at most FANOUT pairs of its own."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    origin = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(400):
        copy = list(origin)
        for at in rng.sample(range(150), 2):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    nodes = near_dup.sketch(near_dup.worded(spark.createDataFrame(rows, "doc_id long, text string")))
    buckets = near_dup.bucketed(nodes)
    assert buckets.count() <= 400 * near_dup.BANDS
    assert 399 <= near_dup.candidates(buckets).count() <= 400 * near_dup.FANOUT


def test_forest_joins_all_promising_classes():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = 30
        classes = rng.integers(0, 12, n)
        agree = rng.integers(0, 125, (n, n)).clip(0, 90)
        rows = np.arange(n)
        found = near_dup.forest(agree, rows, rows, classes)
        assert len(found) < len(set(classes.tolist()))

        def parts(pairs):
            name = {c: c for c in set(classes.tolist())}
            for i, j in pairs:
                a, b = name[int(classes[i])], name[int(classes[j])]
                name = {c: a if x == b else x for c, x in name.items()}
            return {frozenset(c for c in name if name[c] == x) for x in set(name.values())}

        every = [(i, j) for i in range(n) for j in range(n) if agree[i, j] >= near_dup.LEAST_EQUAL and classes[i] != classes[j]]
        assert parts(found) == parts(every)
        assert all(agree[i, j] >= near_dup.LEAST_EQUAL and classes[i] != classes[j] for i, j in found)


def test_classes_of_documents_and_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = check_classes(docs)
    kept = near_dup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if r["kept"])

    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in near_dup.near_classes(odd_docs).collect())
    worded = brute_classes([r for r in rows if (r[1] or "").split()])
    blank = Counter((d, d, 1) for d, t in rows if not (t or "").split())
    assert got == worded + blank
    kept = near_dup.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(x for r in kept.collect() if (x := r["doc_id"]) is not None) == [1, 4, 5, 6, 7, 9, 10, 12, 14]
    assert near_dup.near_classes(no_docs).count() == near_dup.drop_near_copies(no_docs).count() == 0


def test_signature_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(2)
    for size in (10, 400):
        for _ in range(3):
            elements = np.unique(rng.integers(1, 2 ** 62, size).astype(np.uint64))
            a, b = rng.integers(0, 9, len(elements)), rng.integers(0, 9, len(elements))
            want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
            agree = [(near_dup.signature(e[a > 0], a[a > 0]) == near_dup.signature(e[b > 0], b[b > 0])).mean()
                     for i in range(40) if len(e := elements + np.uint64(i << 32)) > 0]
            assert abs(np.mean(agree) - want) < 0.05


def test_shingles_and_similarity():
    a, b = "a b c d e f g a b c d e", "a b c d e f g"
    assert len(near_dup.shingle_hashes(a)) == 8 and len(near_dup.bag_of(a)[0]) == 7
    assert len(near_dup.shingle_hashes("one two")) == 1 and len(near_dup.shingle_hashes("")) == 0
    assert near_dup.similarity(near_dup.bag_of(a), near_dup.bag_of(b)) == brute_similarity(bag(a), bag(b))
    assert len(np.unique(near_dup.shingle_hashes(" ".join(map(str, range(50_000)))))) == 49_996


def test_components_of_a_long_path(spark):
    nodes = [bytes([i]) for i in np.random.default_rng(1).permutation(120)]
    links = [(max(a, b), min(a, b)) for a, b in zip(nodes, nodes[1:])]
    got = near_dup.components(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in links], "node binary, pivot binary")).collect()
    assert len(got) == 119 and {bytes(r["root"]) for r in got} == {min(nodes)}


def test_components_of_many_graphs_and_rounds_few(spark, monkeypatch):
    """Classes of random graphs against a plain version; a round joins three times, and edges that are stars take none."""
    plans, staged = [], near_dup.staged
    monkeypatch.setattr(near_dup, "staged", lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or staged(df, label))
    rng = random.Random(9)
    pairs = {(max(p), min(p)) for p in ((rng.randrange(b, b + 40), rng.randrange(b, b + 40)) for b in range(0, 2000, 40) for _ in range(b // 40)) if p[0] != p[1]}
    root = {x: x for p in pairs for x in p}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    want = {(x, top(x)) for x in root if top(x) != x}
    found = near_dup.components(spark.createDataFrame(sorted(pairs), "node long, pivot long"))
    assert sorted(found.collect()) == sorted(want)
    assert len(plans) > 1 and all(p.count("Join ") <= 3 for p in plans[1:])
    plans.clear()
    again = near_dup.components(found.withColumnRenamed("root", "pivot"))
    assert sorted(again.collect()) == sorted(want) and len(plans) == 1
    assert near_dup.components(found.where("false").withColumnRenamed("root", "pivot")).count() == 0 and len(plans) == 2
