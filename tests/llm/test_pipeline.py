"""The corpus pipeline: stages in order against a plain version of each."""

from collections import Counter

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_exact_mix_shard import brute_poisson
from tests.llm.test_near_dup import brute_classes
from tests.llm.test_tokens import ids_of


def plain_mix(rows):
    import hashlib
    size = Counter()
    for r in rows:
        size[r["source"]] += len((r["text"] or "").encode()) + 1
    total, out = sum(size.values()), Counter()
    for r in rows:
        rate = 1 / len(size) * total / size[r["source"]]
        u = int(hashlib.md5(f"17|{r['doc_id']}|1".encode()).hexdigest()[:13], 16) / 16 ** 13
        assert rate <= 64
        out[r["doc_id"]] += brute_poisson(u, rate)
    return +out


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        out = stage(spark, docs, SF_SMALL)
        if name != "packing":
            assert out.columns == docs.columns
        got = Counter(r["doc_id"] for r in out.collect())
        kept[name] = len(got)
        if name == "language_id":  # every document with words in a known language stays
            assert got == Counter(r["doc_id"] for r in rows if r["text"] and any(c.isalpha() for c in r["text"]))
        elif name == "exact_dedup":
            best = {}
            for r in sorted(rows, key=lambda r: (-len(r["text"]), r["doc_id"])):
                best.setdefault("".join(r["text"].split()), r["doc_id"])
            assert got == Counter(best.values())
        elif name == "near_dedup":
            assert got == Counter({c for _, c, _ in brute_classes([(r["doc_id"], r["text"]) for r in rows])})
        elif name == "mixing":
            assert got == plain_mix(rows)
        else:
            tokens = Counter()
            for r in out.collect():
                tokens[r["doc_id"]] += r["length"]
            want = Counter()
            for r in rows:
                want[r["doc_id"]] += len(ids_of(r["text"])) + 1
            assert tokens == want
        docs = out.checkpoint()
    assert kept["near_dedup"] < kept["exact_dedup"] < docs.count()


def test_run_and_odd_rows(spark, odd_docs, no_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "a" / "documents.parquet"))
    no_docs.write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() > 0
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).count() == 0
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
