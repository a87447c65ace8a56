"""Operators 1 (packing) and 8 (token counts)."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tidemark.llm import packing, queries, token_counts

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODER = packing.DocumentEncoder(*packing.default_paths())


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer_on_documents(spark):
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        assert np.frombuffer(ENCODER(r["text"]), "<u4").tolist() == ids_of(r["text"])


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 'sabÉ9٣½.<|>"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_encoder_equals_tokenizer_on_any_text(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == ids_of(text)


def check_packing(docs):
    got = packing.pack(docs).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        pieces[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for r in docs.collect():
        want[r["doc_id"]] += ids_of(r["text"]) + [0]
    for doc, parts in pieces.items():
        assert sorted(i for _, ids, _ in parts for i in ids) == sorted(want[doc])
    assert set(pieces) == set(want)
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 1024
    return got, sequences


def test_packing(spark, odd_docs, no_docs):
    check_packing(odd_docs)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got, sequences = check_packing(docs)
    want = {r["doc_id"]: ids_of(r["text"]) + [0] for r in docs.collect()}
    for r in got:  # ids are the document's own at that place
        assert np.frombuffer(r["ids"], "<u4").tolist() == want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["doc_tokens"] == len(want[r["doc_id"]])
    fills = [sum(n for _, n in s) for s in sequences.values()]
    assert sum(f < 1024 for f in fills) <= docs.rdd.getNumPartitions()  # one open window at most per partition
    assert packing.pack(no_docs).count() == 0
    crc = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in queries.op1_packing(spark, SF_SMALL).collect()}
    assert crc == {(r["doc_id"], r["start"]): zlib.crc32(bytes(r["ids"])) for r in got}


def brute_level(count, size, window):
    best = None
    for level in range(window - size, -1, -1):
        if level and not count[level]:
            continue
        after = count.copy()
        if level:
            after[level] -= 1
        if level + size < window:
            after[level + size] += 1
        cost = (after[1:] ** 2).sum()
        if best is None or cost < best[0]:
            best = (cost, level)
    return best[1]


def test_sum_of_squares_rule_and_memory_bound(monkeypatch):
    rng, packer = random.Random(3), packing.LevelPacker(32, 0)
    for i in range(800):
        size = rng.randint(1, 31)
        assert packer.best_level(size) == brute_level(packer.count, size, 32)
        packer.place((size, i, 0, size, b"abcd" * size))
    monkeypatch.setattr(packing, "OPEN_WINDOWS", 10)
    packer = packing.LevelPacker(100, 0)
    for i in range(500):
        packer.place((60, i, 0, 60, b"abcd" * 60))  # never two in a window uncut
        assert packer.n_open < 10
    packer.finish(packing.cut_piece)
    assert sum(p[0] for _, _, p in packer.done) == 30000
    assert packer.sequence <= 30000 / 100 + 60


def brute_sections(text, rule):
    text = text or ""
    raw = text.encode()
    lines = text.split("\n")
    spans, at = [], 0
    for i, line in enumerate(lines):
        size = len(line.encode()) + (i < len(lines) - 1)
        if size or i == 0:
            spans.append([at, at + size, 0, 0])
        at += size
    total, at = 0, 0
    for token in ids_of(text):
        size = len(token_bytes[token])
        total += 1
        hits = [s for s in spans if s[0] < at + size and s[1] > at] or [spans[0]]
        owner = hits[0] if rule == "start" else max(hits, key=lambda s: min(s[1], at + size) - max(s[0], at))
        owner[2] += 1
        owner[3] += len(hits) > 1
        at += size
    return [(i, len(raw[:a].decode()), len(raw[:b].decode()), n, x, total) for i, (a, b, n, x) in enumerate(spans)]


token_bytes = {i: b for b, i in ENCODER.ranks.items()}


def test_section_tokens(spark, odd_docs, no_docs):
    texts = ["a\n\n\n  b\n", "\n\n \n x", "é\n\n日本 語\n\n\n\n", "", None, "no feed", "\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rule in ("start", "most"):
        got = defaultdict(list)
        for r in token_counts.section_tokens(docs, rule).collect():
            got[r["doc_id"]].append(tuple(r)[1:])
        assert {i: sorted(v) for i, v in got.items()} == {i: brute_sections(t, rule) for i, t in enumerate(texts)}
    assert any(x[4] for i, t in enumerate(texts) for x in brute_sections(t, "start"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = defaultdict(list)
    for r in token_counts.section_tokens(docs).collect():
        got[r["doc_id"]].append(tuple(r)[1:])
    for r in docs.collect():
        assert sorted(got[r["doc_id"]]) == brute_sections(r["text"], "start")
    assert token_counts.section_tokens(no_docs).count() == 0
    assert token_counts.section_tokens(odd_docs).select("doc_id").distinct().count() == odd_docs.select("doc_id").distinct().count()
