"""String Column expressions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's ``str.strip()`` treats as white space.
_WS = "[\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# the same white space as single characters, for a regex-free edge test
_WS_CHARS = ([chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680)]
             + [chr(c) for c in range(0x2000, 0x200B)]
             + [chr(c) for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])


_LIT_CACHE: dict = {}


def char_literals(chars) -> list[Column]:
    """Literal Columns for a fixed character set, built once per Spark
    context (an ``isin`` over them becomes a hash-set test)."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    key = (id(sc), tuple(chars))
    if key not in _LIT_CACHE:
        _LIT_CACHE[key] = [F.lit(ch) for ch in chars]
    return _LIT_CACHE[key]


def ustrip(col) -> Column:
    """Unicode-aware strip (FN-13); Spark's ``trim`` only removes spaces.
    The regex runs only when the first or last character is white space
    (a set lookup), so clean cells cost no regex."""
    c = _c(col)
    ws = char_literals(_WS_CHARS)
    edge = F.substring(c, 1, 1).isin(*ws) | F.substring(c, -1, 1).isin(*ws)
    return F.when(edge, F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")).otherwise(c)


def clean_label(col) -> Column:
    """Column-name cleaning (PRJ-1): strip, then every run of non
    alphanumerics becomes one underscore."""
    return F.regexp_replace(ustrip(col), "[^A-Za-z0-9]+", "_")


def strip_quotes(col) -> Column:
    """Remove both quote characters (header labels, attribute text)."""
    return F.regexp_replace(_c(col), "[\"']", "")


def strip_tags(col) -> Column:
    """Remove HTML tags and double quotes (FN-2, summaries)."""
    return F.regexp_replace(_c(col), '<[^>]*>|"', "")


def wrap_text(col, width: int = 80) -> Column:
    """Wrap at ``width`` (FN-1): words longer than ``width`` stay whole,
    every piece is stripped, pieces are joined with a newline.

    White space is the explicit class Python uses; ``[^\\n]`` stands for
    "any character but newline" (Java's ``.`` also stops at carriage
    returns and Unicode line separators).
    """
    nws = "[^" + _WS[1:]
    rx = f"((?:{nws}{{{width + 1},}}|[^\\n]{{1,{width}}})(?:{_WS}+|$))"
    pieces = F.regexp_extract_all(_c(col), F.lit(rx), 1)
    return F.array_join(F.transform(pieces, lambda p: ustrip(p)), "\n")


def to_ascii(col, mode: str = "replace") -> Column:
    """ASCII transliteration (COE-5): each non-ASCII character becomes
    ``?`` (``replace``) or is removed (``ignore``)."""
    repl = "?" if mode == "replace" else ""
    return F.regexp_replace(_c(col), r"[^\x00-\x7F]", repl)


def title_label(col) -> Column:
    """Python ``str.title`` for labels made of letters, digits and ``_``
    (FN-11): a letter is upper-cased when the previous character is not a
    letter, every other letter is lower-cased."""
    low = F.lower(_c(col))
    # a letter that starts a run of letters
    return F.regexp_replace(
        F.initcap(F.regexp_replace(low, "([^a-z])([a-z])", "$1 $2")),
        "([^A-Za-z]) ([A-Za-z])", "$1$2")


def file_stem(col) -> Column:
    """Base name without the last extension (FN-8)."""
    base = F.regexp_extract(_c(col), r"([^/\\]*)$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")


def file_ext(col) -> Column:
    """Lower-case extension including the dot, '' when absent (FN-8)."""
    base = F.regexp_extract(_c(col), r"([^/\\]*)$", 1)
    return F.lower(F.regexp_extract(base, r"(\.[^.]*)$", 1))


def part_base(col) -> Column:
    """Dataset name of a paged file: ``x_part3`` -> ``x`` (FN-8)."""
    return F.regexp_replace(_c(col), r"_part\d+$", "")


def contains_any(col, terms: list[str]) -> Column:
    """True when the lower-cased text contains any of ``terms`` (a short
    fixed list: an OR chain keeps the test inside generated code)."""
    low = F.lower(_c(col))
    out = F.lit(False)
    for t in terms:
        out = out | (F.instr(low, F.lit(t)) > 0)
    return out


def first_contained(col, terms: list[str]) -> Column:
    """First of ``terms`` (in list order) contained in the lower-cased
    text, else NULL (a CASE chain over the short fixed list)."""
    low = F.lower(_c(col))
    out = F.lit(None).cast("string")
    for t in reversed(terms):
        out = F.when(F.instr(low, F.lit(t)) > 0, F.lit(t)).otherwise(out)
    return out
