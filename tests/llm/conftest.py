import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows,
    and further columns named like the operators' own."""
    words = " ".join(f"word{i % 977} talk{i % 31}" for i in range(40_000))
    base = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base.replace(" ", "  "), "en", None, None),
        (4, None, "en", "a", None), (5, "", None, "b", 0), (6, " \n\t ", "fr", "b", 3), (None, base, None, "a", 1),
        (None, None, None, None, None), (7, words, "en", "b", len(words)), (8, words + " end", "en", "b", 1),
        (9, "le chat est sur la table et le chien dort dans la maison avec les enfants", "fr", "c", 1),
        (10, "12345 67890 !!!", "fr", "c", 1), (11, base.upper(), "en", "c", 1), (12, "école déjà vu\nnaïve café 😀 日本語", "fr", "c", 1),
        (13, base + " today", "en", "a", 1), (14, "short", "en", "a", 1), (15, "short", "en", "a", 1),
    ]
    extra = "sha string, salt int, run int, rate double, copies int, node string, shard int, block int, words string"
    return spark.createDataFrame([r + ("x", 1, 2, 0.5, 3, "n", 9, 9, "w") for r in rows], f"{DOCS}, {extra}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
