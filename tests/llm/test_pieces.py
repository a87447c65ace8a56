"""Operator 12 (SentencePiece encoding with source offsets), against the library."""

import random

import numpy as np
import pytest
import sentencepiece

from tests.conftest import SF_SMALL
from tidemark.llm import pieces

ODD = ["", " ", "  ", "▁", "▁▁ a", "a▁b", "\n\t x", "<s>", "</s> a", "<0x0A>", "€\U0001F9FF", "  　 ", "\0a", "é", " a", "a "]


@pytest.fixture(scope="module")
def codec():
    with open(pieces.default_model(), "rb") as f:
        return pieces.PieceCodec(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def odd_texts(n=1500):
    rng = random.Random(1)
    alphabet = " ▁abcthe\n\té日<>0x\U0001F9FF"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def numbers(data):
    return np.frombuffer(data, "<u4").tolist()


def test_ids_spans_and_texts_equal_the_library(codec, library, monkeypatch):
    monkeypatch.setattr(pieces, "DECODE_IDS", 3)
    assert codec.by_word
    for text in odd_texts():
        found = codec.encode(text)
        ids = numbers(found.ids)
        assert ids == library.encode(text, add_bos=True, add_eos=True), text
        ends = numbers(found.ends)
        assert ends[0] == 0 and ends[-1] == len(text.encode())
        assert ends[1:-1] == [p.end for p in library.encode(text, return_type="proto").pieces], text
        assert codec.decode(found.ids) == library.decode(ids), text


def test_slices_and_whole_texts_agree(codec, library, monkeypatch):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgé ") for _ in range(rng.randint(1, 9))) for _ in range(3000)) + " " + "x" * 900
    want = library.encode(text, add_bos=True, add_eos=True)
    assert numbers(codec.encode(text).ids) == want
    monkeypatch.setattr(pieces, "SLICE", 50)
    assert numbers(codec.encode(text).ids) == want and len(list(codec.slices(codec.normalize(text.encode())[0].decode()))) > 100
    monkeypatch.setattr(codec, "by_word", False)
    assert numbers(codec.encode(text).ids) == want


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("fold", [True, False])
def test_compiled_character_map(rule, fold):
    """Longest prefixes and alignment of maps that do change texts."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=fold, add_dummy_prefix=True, escape_whitespaces=True)
    mine = pieces.Normalizer(library.serialized_normalizer_spec(), [])
    rng = random.Random(2)
    for _ in range(800):
        text = "".join(rng.choice(" ﬁ　Ａ①㍿aBc é́e\t\n​日ｶﾞ­ßİ ≠") for _ in range(rng.randint(0, 20)))
        want, offsets = library.normalize(text, with_offsets=True)
        got, origin = mine(text.encode())
        assert got.decode() == want
        assert [int(origin[len(want[:i].encode())]) for i in range(len(want) + 1)] == [len(text[:o].encode()) for o in offsets]


def test_user_symbols_are_kept_from_the_map():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=False)
    mine = pieces.Normalizer(library.serialized_normalizer_spec(), ["①x".encode(), "①".encode()])
    assert mine("①xﬁ①Ａ".encode())[0].decode().endswith("A") and mine("①xﬁ①".encode())[0].decode().strip("▁") == "①xfi①"


def test_documents_and_odd_rows(spark, odd_docs, no_docs, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = odd_docs.select("doc_id", "text").union(spark.createDataFrame(enumerate(odd_texts(50)), "doc_id long, text string"))
    for df in (docs, odd):
        want = sorted((repr(r["doc_id"]), ids, library.decode(ids)) for r in df.collect()
                      for ids in [library.encode(r["text"] or "", add_bos=True, add_eos=True)])
        got = pieces.encode_decode(df).collect()
        assert sorted((repr(r["doc_id"]), numbers(r["ids"]), r["decoded"]) for r in got) == want
        assert all(r["n_tokens"] == len(r["ids"]) // 4 == len(r["ends"]) // 4 for r in got)
    assert pieces.encode_decode(odd_docs).count() == odd_docs.count()
    assert pieces.encode_decode(no_docs).count() == 0


def test_spans_of_pieces(spark, library, monkeypatch):
    text = "naïve café, twice  the\nway"
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    rows = pieces.piece_spans(pieces.encode_decode(df)).orderBy("doc_id", "pos").collect()
    assert [(r["pos"], r["id"], r["start"], r["end"]) for r in rows if r["doc_id"] == 2] == [(0, 1, 0, 0), (1, 2, 0, 0)]
    mine = [r for r in rows if r["doc_id"] == 1]
    assert b"".join(text.encode()[r["start"]:r["end"]] for r in mine) == text.encode()
    assert [r["id"] for r in mine] == library.encode(text, add_bos=True, add_eos=True)
