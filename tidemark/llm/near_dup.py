"""Near-duplicate classes by BagMinHash (operator 9).

A document is the bag (multiset) of its shingles of five words. Its signature is
that of BagMinHash: every shingle owns Poisson processes over time, one per
doubling block [0,1), [1,2), [2,4), … of the weight axis, with the block's
length as rate. A point has a uniform signature slot and a uniform place
inside its block, and counts only if that place lies below the shingle's
weight. A slot keeps the earliest time that hits it, so two bags agree in a slot
with a probability equal to their weighted Jaccard similarity. Points come in
order of time and end once every slot is hit, so long texts cost little more
than reading them.

Signatures are cut into ``BANDS`` × ``ROWS_PER_BAND``; documents that agree in a
band share a bucket. Copies with the same words are one node before that. Links
are found in three steps, so that large groups cost little and none is lost:

1. Every node meets the ``FANOUT`` of its buckets' smallest and largest nodes with
   which it shares most buckets. Pairs whose signatures agree in too few slots are
   dismissed (chance of losing a pair at 0.8: about 1e-5), the others are verified
   exactly: overlap of the two bags from their whole texts, 0.8 or more.
2. In every bucket that holds nodes of several classes, the nodes outside its
   largest class meet all nodes of the bucket by their digests, in blocks of about
   ``BLOCK_NODES`` nodes a side. Of the promising pairs of a block a spanning
   forest over the classes is handed back (never more rows than nodes) and
   verified. Buckets with the same nodes are taken once.
3. Verified links make classes, promising pairs clusters. In a cluster of several
   classes and more than two nodes, every node outside the cluster's largest class
   meets all nodes of the cluster with its whole text, in blocks as well. This part
   grows with the square of a cluster of texts that are alike but not linked.

Classes are found by alternating large and small stars; a class is named by its
smallest doc_id.

Defined cases: words are runs without white space, case folded; texts under
five words are one shingle of all their words; null, empty and blank texts
have no words and stay in a class of their own each; null doc_id is never a
class's name unless no other is there; repeated rows share a class; an
empty table gives no rows; further columns are ignored (``near_classes``) or kept
(``drop_near_copies``, where rows that agree in doc_id and text count as one).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, quoted, staged, text_or_empty
from tidemark.session import ship_by_value

WORDS = 5                 # words of a shingle
SIMILARITY = 0.8          # weighted Jaccard of linked documents
BANDS, ROWS_PER_BAND = 25, 5
SLOTS = BANDS * ROWS_PER_BAND
FANOUT = 4                # pairs of a node in the first step
LEAST_EQUAL = 80          # of SLOTS that agree for a pair to be verified
BLOCK_NODES = 512         # nodes per side of a block in which all are compared
BLOCK_CHARS = 4 << 20     # characters of a side of a block of whole texts, about
BROADCAST_NODES = 500_000  # keys of at most 16 bytes that may be broadcast (about 40 MB)

MIX1, MIX2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
S30, S27, S31, S32, S11 = (np.uint64(x) for x in (30, 27, 31, 32, 11))


# ---- inside the tasks: NumPy on one text at a time ----

def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> S30)) * MIX1
    x = (x ^ (x >> S27)) * MIX2
    return x ^ (x >> S31)


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * STEP)
WORD_FACTORS = mixed(np.arange(1001, 1001 + WORDS, dtype=np.uint64) * STEP) | np.uint64(1)
PLACE_BASE = np.uint64(0x9FB21C651E98DF25)


def shingle_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the shingles of a text whose words have one space between them."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    blank = raw == 32
    starts = np.concatenate([[0], np.flatnonzero(blank) + 1])
    lengths = np.diff(np.append(starts, len(raw) + 1))
    place = np.arange(len(raw)) - np.repeat(starts, lengths)[:len(raw)]
    powers = np.cumprod(np.full(int(lengths.max()) + 1, PLACE_BASE, np.uint64))
    values = BYTE_VALUES[raw] * powers[place]
    values[blank] = 0
    words = mixed(np.add.reduceat(values, starts))
    if len(words) < WORDS:
        return mixed(np.array([(words * WORD_FACTORS[:len(words)]).sum() + np.uint64(len(words))], np.uint64))
    count = len(words) - WORDS + 1
    total = np.zeros(count, np.uint64)
    for j in range(WORDS):
        total += words[j:j + count] * WORD_FACTORS[j]
    return mixed(total)


def bag_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingle_hashes(text), return_counts=True)


def blocks_of(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """(seed, rate, weight inside) per element and doubling block its weight reaches."""
    seeds, rates, inside = [mixed(elements)], [np.ones(len(elements))], [np.ones(len(elements))]
    low = 1
    while len(elements):
        over = weights > low
        elements, weights = elements[over], weights[over]
        seeds.append(mixed(elements + STEP * np.array([low + 1], np.uint64)))
        rates.append(np.full(len(elements), float(low)))
        inside.append(np.minimum(weights - low, low).astype(np.float64))
        low *= 2
    return np.concatenate(seeds), np.concatenate(rates), np.concatenate(inside)


def signature(elements: np.ndarray, weights: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """BagMinHash signature: per slot the earliest time of a point that counts."""
    seeds, rates, inside = blocks_of(elements, weights)
    horizon = slots * (np.log(slots) + 4) / inside.sum()
    while True:
        best = np.full(slots, np.inf)
        seed, rate, part, time, k = seeds, rates, inside, np.zeros(len(seeds)), 0
        wide = int(min(max(np.ceil(horizon * rates.mean()), 2), 64))  # points of a process drawn at once
        while len(seed):
            first = mixed(seed[:, None] + np.arange(k + 1, k + wide + 1, dtype=np.uint64) * STEP)
            gaps = np.log(((first >> S11).astype(np.float64) + 1) * 2.0 ** -53) / -rate[:, None]
            # summed one after the other, so a point's time does not depend on ``wide``
            times = np.add.accumulate(np.concatenate([time[:, None], gaps], axis=1), axis=1)[:, 1:]
            early = times <= horizon
            of = np.nonzero(early)[0]
            second = mixed(first[early] ^ MIX2)
            counts = (second & np.uint64(0xFFFFFFFF)).astype(np.float64) * (rate[of] / 2.0 ** 32) < part[of]
            slot = ((second[counts] >> S32) * np.uint64(slots) >> S32).astype(np.int64)
            np.minimum.at(best, slot, times[early][counts])
            live = early[:, -1]
            seed, rate, part, time, k = seed[live], rate[live], part[live], times[live, -1], k + wide
        if best.max() <= horizon:
            return best.astype(np.float32)  # the last bits of a logarithm may differ between processors
        horizon *= 2


def band_keys(sign: np.ndarray) -> np.ndarray:
    bits = mixed(sign.view(np.uint32).astype(np.uint64) + STEP).reshape(BANDS, ROWS_PER_BAND)
    factors = mixed(np.arange(1, ROWS_PER_BAND + 1, dtype=np.uint64) * MIX1) | np.uint64(1)
    return mixed((bits * factors).sum(axis=1) + np.arange(1, BANDS + 1, dtype=np.uint64) * STEP).view(np.int64)


def block_links(mine: list[str], theirs: list[str], classes: np.ndarray) -> list[tuple[int, int]]:
    """(i, j): a linked text of ``theirs`` for each text of ``mine`` and class of ``theirs``."""
    bags = [bag_of(t) for t in theirs]
    owner = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])
    hashes, weights = (np.concatenate([b[k] for b in bags]) for k in (0, 1))
    order = np.argsort(hashes, kind="stable")
    hashes, weights, owner = hashes[order], weights[order], owner[order]
    totals = np.array([w.sum() for _, w in bags])
    found = []
    for i, text in enumerate(mine):
        own, times = bag_of(text)
        first, last = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
        sizes = last - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        shared = np.bincount(owner[at], np.minimum(weights[at], np.repeat(times, sizes)), len(bags))
        linked = np.flatnonzero(shared >= SIMILARITY * (times.sum() + totals - shared) - 1e-9)
        linked = linked[[similarity((own, times), bags[j]) >= SIMILARITY for j in linked]] if len(linked) else linked
        found += [(i, int(linked[k])) for k in np.unique(classes[linked], return_index=True)[1]]
    return found


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / max(1, int(a[1].sum() + b[1].sum()) - shared)


# ---- the Spark plan ----

def words_of(text: Column) -> Column:
    """The words of a text with one space between them."""
    return F.trim(F.regexp_replace(F.lower(text_or_empty(text)), r"\s+", " "))


def node_of(words: Column) -> Column:
    """Key of a word sequence; null without words."""
    return F.when(words != "", F.unhex(F.md5(words)))


def worded(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, text)`` → row (a number of its own), doc_id, text_key, words_key, words."""
    return (rows.withColumn("words", words_of(F.col("text")))
            .select(F.monotonically_increasing_id().alias("row"), "doc_id", F.unhex(F.md5(text_or_empty(F.col("text")))).alias("text_key"),
                    node_of(F.col("words")).alias("words_key"), "words"))


def sketch(texts: DataFrame) -> DataFrame:
    """``texts(row, words)`` → node (the row), bands, digest (8 bits per slot)."""
    ship_by_value(sys.modules[__name__])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands, digests = [], []
            for words in batch.column(1):
                sign = signature(*bag_of(words.as_py()))
                bands.append(band_keys(sign))
                digests.append((mixed(sign.view(np.uint32).astype(np.uint64) * STEP) >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bands, pa.list_(pa.int64())), pa.array(digests, pa.binary())],
                                             ["node", "bands", "digest"])
        pa.default_memory_pool().release_unused()  # the worker stays for other tasks

    return texts.select("row", "words").mapInArrow(sketched, "node long, bands array<long>, digest binary")


def only(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` whose ``name`` is among the distinct ``keys(name)``."""
    return df.join(F.broadcast(keys) if keys.count() <= BROADCAST_NODES else keys, name, "left_semi")


def bucketed(nodes: DataFrame) -> DataFrame:
    """bucket, node, low, high (its smallest and largest node) of the buckets of
    two nodes or more, from ``nodes(node, bands)``."""
    member = nodes.select(F.explode("bands").alias("bucket"), "node")
    shared = (member.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .where(F.col("low") < F.col("high")))
    return member.join(shared, "bucket")


def candidates(buckets: DataFrame) -> DataFrame:
    """(node, pivot), pivot < node, once each: every node of ``bucketed`` with the
    ``FANOUT`` ends of its buckets that share most buckets with it."""
    met = (buckets.select("node", F.explode(F.array("low", "high")).alias("pivot")).where(F.col("pivot") != F.col("node"))
           .groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("n")))
    most = F.slice(F.sort_array(F.collect_list(F.struct("n", "pivot")), asc=False), 1, FANOUT)  # of 2 × BANDS at most
    best = met.groupBy("node").agg(most.alias("best")).select("node", F.explode("best.pivot").alias("pivot"))
    return best.select(F.greatest("node", "pivot").alias("node"), F.least("node", "pivot").alias("pivot")).distinct()


def promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in ``LEAST_EQUAL`` slots."""
    mine = nodes.select("node", F.col("digest").alias("a"))
    theirs = nodes.select(F.col("node").alias("pivot"), F.col("digest").alias("b"))

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, SLOTS) for c in (2, 3))
                keep = pa.array((a == b).sum(axis=1) >= LEAST_EQUAL)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["node", "pivot"]).filter(keep)

    return (pairs.join(mine, "node").join(theirs, "pivot").select("node", "pivot", "a", "b")
            .mapInArrow(agreeing, "node long, pivot long"))


def texts_of(texts: DataFrame, *pairs: DataFrame) -> DataFrame:
    """(node, words) of the nodes of ``pairs``."""
    ends = [p.select(c).toDF("row") for p in pairs for c in ("node", "pivot")]
    needed = staged(reduce(DataFrame.union, ends).distinct(), "needed")
    return staged(only(texts.select("row", "words"), needed, "row").withColumnRenamed("row", "node"), "words")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose bags overlap by ``SIMILARITY``: node, pivot."""

    def overlapping(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, None
        for batch in batches:
            found = []
            for pivot, mine, theirs in zip(*(batch.column(c) for c in (1, 2, 3))):
                if pivot != last:  # rows come sorted by pivot
                    last, bag = pivot, bag_of(theirs.as_py())
                found.append(similarity(bag, bag_of(mine.as_py())) >= SIMILARITY)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["node", "pivot"])
            yield out.filter(pa.array(found, pa.bool_()))

    return (pairs.join(texts.select("node", F.col("words").alias("mine")), "node")
            .join(texts.select(F.col("node").alias("pivot"), F.col("words").alias("theirs")), "pivot")
            .select("node", "pivot", "mine", "theirs")
            .mapInArrow(overlapping, "node long, pivot long"))


def with_roots(found: DataFrame) -> DataFrame:
    """(node, root) of ``components`` with the roots themselves."""
    return found.union(found.select("root", "root").distinct())


def two_components(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``components`` of two graphs in one run; the lowest bit keeps their nodes apart."""
    def marked(links: DataFrame, mark: int) -> DataFrame:
        return links.select(*[(F.col(c) * 2 + mark).alias(c) for c in ("node", "pivot")])

    def own(mark: int) -> DataFrame:
        return found.where(F.col("node").bitwiseAND(F.lit(1)) == mark).select(
            *[F.shiftright(c, 1).alias(c) for c in ("node", "root")])

    found = components(marked(first, 0).union(marked(second, 1)))
    return own(0), own(1)


def forest(agree: np.ndarray, mine: np.ndarray, theirs: np.ndarray, classes: np.ndarray) -> list[tuple[int, int]]:
    """Of the promising pairs (mine[i], theirs[j]) of different classes, those of
    a spanning forest over the classes, best agreement first."""
    own, other = classes[mine], classes[theirs]
    i, j = np.nonzero((agree >= LEAST_EQUAL) & (own[:, None] != other[None, :]))
    order = np.argsort(-agree[i, j].astype(np.int64), kind="stable")
    kind: dict[int, int] = {}

    def top(c: int) -> int:
        while kind.get(c, c) != c:
            kind[c] = kind.get(kind[c], kind[c])
            c = kind[c]
        return c

    found = []
    _, first = np.unique(np.stack([own[i[order]], other[j[order]]]), axis=1, return_index=True)  # the best of two classes
    for k in order[np.sort(first)]:
        a, b = top(int(own[i[k]])), top(int(other[j[k]]))
        if a != b:
            kind[a] = b
            found.append((int(mine[i[k]]), int(theirs[j[k]])))
    return found


def dealt(members: DataFrame, group: str, largest: DataFrame) -> DataFrame:
    """``members(group, node, class, ...)`` of the groups in ``largest(group,
    top, my_blocks, their_blocks)``, once per block pair: with ``own`` the nodes
    outside the top class, without it all."""
    block = F.xxhash64("node")
    spread = members.join(F.broadcast(largest) if largest.count() <= BROADCAST_NODES else largest, group)
    theirs = spread.withColumns({"own": F.lit(False), "theirs": F.pmod(block, F.col("their_blocks")).cast("int"),
                                 "mine": F.explode(F.sequence(F.lit(0), F.col("my_blocks") - 1))})
    mine = spread.where(F.col("class") != F.col("top")).withColumns(
        {"own": F.lit(True), "theirs": F.explode(F.sequence(F.lit(0), F.col("their_blocks") - 1)),
         "mine": F.pmod(block, F.col("my_blocks")).cast("int")})
    return theirs.unionByName(mine).drop("top", "my_blocks", "their_blocks")


def blocks(rows: Column, size: Column, per_rows: int, per_size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / per_rows), F.ceil(size / per_size)).cast("int")


def across_classes(buckets: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Promising pairs (node, pivot) that join the classes of a bucket, from the
    digests of all nodes of every bucket with more than one class."""
    classed = staged(buckets.select("bucket", "node").join(classes, "node", "left")
                     .select("bucket", "node", F.coalesce("root", "node").alias("class")), "classed")
    # one row per class of a bucket, then per bucket; the hashes name its set of nodes
    sizes = classed.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("a"),
                                                   F.bit_xor(F.xxhash64(F.col("node") * 2 + 1)).alias("b"))
    several = (sizes.groupBy("bucket").agg(F.sum("n").alias("all"), F.max(F.struct("n", "class")).alias("top"),
                                           F.count(F.lit(1)).alias("classes"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
               .where("classes > 1"))
    largest = staged(several.groupBy("all", "a", "b").agg(F.min(F.struct("bucket", "top")).alias("one")).select(
        "one.bucket", F.col("one.top.class").alias("top"), blocks(F.col("all") - F.col("one.top.n"), F.lit(0), BLOCK_NODES, 1).alias("my_blocks"),
        blocks(F.col("all"), F.lit(0), BLOCK_NODES, 1).alias("their_blocks")), "largest")
    key = ["bucket", "mine", "theirs"]
    # the digests once per node and block pair; a block pair is one run of rows in one task
    rows = (dealt(classed, "bucket", largest).join(nodes.select("node", "digest"), "node")
            .select(*key, "own", "node", "class", "digest").repartition(*key).sortWithinPartitions(*key))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs_of(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table.column(k).to_numpy() for k in key], axis=1)
            own, node, kind = (table.column(k).to_numpy() for k in ("own", "node", "class"))
            digest = np.frombuffer(b"".join(table.column("digest").to_pylist()), np.uint8).reshape(-1, SLOTS)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            found = []
            for start, end in zip(cuts, cuts[1:]):
                mine, theirs = (start + np.flatnonzero(own[start:end] == x) for x in (True, False))
                if len(mine) and len(theirs):
                    agree = np.stack([(digest[theirs] == digest[i]).sum(axis=1) for i in mine])
                    found += [(int(node[i]), int(node[j])) for i, j in forest(agree, mine, theirs, kind)]
            return pa.RecordBatch.from_arrays([pa.array([f(p) for p in found], pa.int64()) for f in (max, min)], ["node", "pivot"])

        kept: pa.Table | None = None  # the last run may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            if not table.num_rows:
                continue
            keys = np.stack([table.column(k).to_numpy() for k in key], axis=1)
            whole = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1:].sum() + 1) if (keys != keys[-1]).any() else 0
            if whole:
                yield pairs_of(table.slice(0, whole))
            kept = table.slice(whole)
        if kept is not None and kept.num_rows:
            yield pairs_of(kept)

    return rows.mapInArrow(compared, "node long, pivot long").distinct()


def remaining_links(clusters: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (node, pivot) not found yet: in every cluster of several classes
    and more than two nodes, the nodes outside its largest class against all,
    from their whole texts, block by block."""
    members = staged(clusters.withColumnRenamed("root", "cluster").join(classes, "node", "left")
                     .select("cluster", "node", F.coalesce("root", "node").alias("class")), "clusters")
    sizes = members.groupBy("cluster", "class").agg(F.count(F.lit(1)).alias("n"))
    open_ = staged(sizes.groupBy("cluster").agg(F.sum("n").alias("all"), F.max(F.struct("n", "class")).alias("top"))
                   .where((F.col("all") > 2) & (F.col("top.n") < F.col("all"))), "open")
    small = open_.count() <= BROADCAST_NODES
    inside = members.join(F.broadcast(open_) if small else open_, "cluster")
    needed = staged(inside.select(F.col("node").alias("row")), "needed")
    words = only(texts.select("row", "words"), needed, "row").withColumnRenamed("row", "node")
    spread = staged(inside.join(words, "node").withColumn("chars", F.length("words").cast("long")), "spread")
    largest = staged(spread.groupBy("cluster").agg(F.first("all").alias("all"), F.first("top.n").alias("n"), F.first("top.class").alias("top"),
                                                   F.sum("chars").alias("chars"),
                                                   F.sum(F.when(F.col("class") != F.col("top.class"), F.col("chars"))).alias("outside")).select(
        "cluster", "top", blocks(F.col("all") - F.col("n"), F.col("outside"), BLOCK_NODES, BLOCK_CHARS).alias("my_blocks"),
        blocks(F.col("all"), F.col("chars"), BLOCK_NODES, BLOCK_CHARS).alias("their_blocks")), "largest")
    rows = dealt(spread.select("cluster", "node", "class", "words"), "cluster", largest)

    def compared(block: pd.DataFrame) -> pd.DataFrame:
        left, right = block[block["own"]], block[~block["own"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "pivot": []})
        kinds = right["class"].to_numpy()
        mine, theirs, own = left["node"].to_numpy(), right["node"].to_numpy(), left["class"].to_numpy()
        pairs = [(int(mine[i]), int(theirs[j])) for i, j in block_links(left["words"].tolist(), right["words"].tolist(), kinds)
                 if own[i] != kinds[j]]
        return pd.DataFrame({"node": [max(p) for p in pairs], "pivot": [min(p) for p in pairs]})

    return rows.groupBy("cluster", "mine", "theirs").applyInPandas(compared, "node long, pivot long")


def open_ends(edges: DataFrame) -> int:
    """Nodes that keep ``edges(node, pivot)`` from being stars: those with
    several pivots, or with one while they are a pivot themselves."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("node").alias("end"), F.lit(1).alias("below")),
                                         F.struct(F.col("pivot").alias("end"), F.lit(0).alias("below")))))
    return (ends.groupBy("end").agg(F.sum("below").alias("n"), F.min("below").alias("least"))
            .where(F.col("n") > F.col("least")).agg(F.count(F.lit(1))).first()[0])


def stars(edges: DataFrame) -> DataFrame:
    """One large and one small star of ``edges(node, pivot)``, pivot < node. The
    least neighbour of a pivot is its own least pivot, or itself, so edges are read one way only."""
    least = edges.groupBy(F.col("node").alias("pivot")).agg(F.min("pivot").alias("least"))
    large = edges.join(least, "pivot", "left").select("node", F.coalesce("least", "pivot").alias("pivot"))
    small = large.join(large.groupBy("node").agg(F.min("pivot").alias("least")), "node")
    below = F.struct("node", F.col("least").alias("pivot"))
    beside = F.struct(F.col("pivot").alias("node"), F.col("least").alias("pivot"))
    return small.select(F.inline(F.when(F.col("pivot") == F.col("least"), F.array(below)).otherwise(F.array(below, beside)))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node but the roots, from ``links(node,
    pivot)`` with pivot < node: alternating large and small stars. Rounds cost the
    driver plans, stages and broadcasts, so none is run once the edges are stars."""
    edges = staged(links.select("node", "pivot").distinct(), "edges")
    while open_ends(edges):
        edges = staged(stars(edges), "edges")
    return edges.withColumnRenamed("pivot", "root")


def rooted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_key and root of every row (null without words)."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text"))
    texts = staged(worded(rows), "texts")
    # one row stands for all with the same words; its number is the node
    firsts = staged(texts.where(F.col("words_key").isNotNull()).groupBy("words_key").agg(F.min("row").alias("row")), "firsts")
    nodes = staged(sketch(only(texts.select("row", "words"), firsts.select("row"), "row")), "nodes")
    buckets = staged(bucketed(nodes), "buckets")
    pairs = staged(promising(candidates(buckets), nodes), "pairs")
    links = staged(verified(pairs, texts_of(texts, pairs)), "links")
    classes = components(links)
    across = staged(across_classes(buckets, classes, nodes), "across")
    if across.limit(1).count():
        new = staged(across.join(pairs, ["node", "pivot"], "left_anti"), "new")
        linked = classes.withColumnRenamed("root", "pivot")
        classes, clusters = two_components(linked.union(verified(new, texts_of(texts, new))), linked.union(across))
        more = staged(remaining_links(with_roots(clusters), with_roots(classes), texts), "more")
        if more.limit(1).count():
            classes = components(classes.withColumnRenamed("root", "pivot").union(more))
    named = (classes.join(firsts.select(F.col("row").alias("node"), "words_key"), "node")
             .join(firsts.select(F.col("row").alias("root"), F.col("words_key").alias("root_key")), "root").select("words_key", "root_key"))
    return (texts.select("doc_id", "text_key", "words_key").join(named, "words_key", "left")
            .select("doc_id", "text_key", F.coalesce("root_key", "words_key").alias("root")))


def shared_roots(found: DataFrame, *what: Column) -> DataFrame:
    """Roots of more than one row, with ``what`` and class_size; broadcast
    below ``BROADCAST_NODES``, so a class that holds much of the corpus is not
    gathered in one task of the join (beyond, skew joins split it)."""
    roots = staged(found.where(F.col("root").isNotNull()).groupBy("root")
                   .agg(F.count(F.lit(1)).alias("class_size"), *what).where("class_size > 1"), "classes")
    return F.broadcast(roots) if roots.count() <= BROADCAST_NODES else roots


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept (its class's smallest doc_id)."""
    found = staged(rooted(docs, doc_id, text).drop("text_key"), "rooted")
    classes = shared_roots(found, F.min("doc_id").alias("class_id"))
    alone = F.col("class_size").isNull()
    return (found.join(classes, "root", "left")
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id"))))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (all its columns) with one document of each class: that of the smallest doc_id."""
    found = staged(rooted(docs, doc_id, text).where(F.col("root").isNotNull()), "rooted")
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = shared_roots(found, F.min(name).alias("stays"))
    own, key = free_name(docs, "near_id"), free_name(docs, "near_text_key")
    gone = staged(found.join(classes, "root").where(name != F.col("stays"))
                  .select(F.col("doc_id").alias(own), F.col("text_key").alias(key)).distinct(), "gone")
    small = gone.count() <= BROADCAST_NODES
    keyed = docs.withColumn(key, F.unhex(F.md5(text_or_empty(quoted(text)))))
    gone = gone.withColumnRenamed(key, key + "_")
    return keyed.join(F.broadcast(gone) if small else gone,
                      keyed[key].eqNullSafe(gone[key + "_"]) & keyed[doc_id].eqNullSafe(gone[own]), "left_anti").drop(key)
