"""Rules as tables: the first term (in rule order) that a text contains, for
any number of rules (JOIN-13, PRJ-6, PRJ-7).

Short fixed lists stay CASE chains inside generated code
(``functions.text.first_contained``). A table of rules is joined instead:
every distinct text is cut into its substrings of the lengths that occur
among the terms, the substrings meet the terms in an equi-join, and the
smallest rule number per text wins. Up to ``BROADCAST_TERMS`` terms are sent to
all tasks: a text's substrings then live and die in the task that cuts them, and
only the texts and the rows are shuffled, once for all columns and kinds of
rules that are asked for together. Beyond that the substrings are shuffled
to the terms. Texts are never collected, a term is one row of the join however
often it is listed, and plans do not grow with the rules.

Defined cases: terms and texts are compared in lower case; null terms are no
rules; the empty term is contained in every text; null texts contain nothing;
of rules with the same number the smaller term wins; further columns of
``df`` are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BROADCAST_TERMS = 2_000_000  # distinct terms that are sent to all tasks


def first_rules(df: DataFrame, asked: dict[str, tuple[str, str]], rules: DataFrame, value: str | None = None) -> DataFrame:
    """``df`` with a column per entry of ``asked`` (``out: (col, kind)``): the
    ``value`` (default: the lower-cased term) of the first of the ``kind``'s
    ``rules(kind, ord, term, …)`` whose term the text ``col`` contains, else NULL."""
    given, kinds = F.col(value) if value else F.lower("term"), sorted({k for _, k in asked.values()})
    kind = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")).cast("int")
    terms = (rules.where(F.col("term").isNotNull() & F.col("kind").isin(*kinds))
             .groupBy(kind.alias("_kind"), F.lower("term").alias("_term"))
             .agg(F.min(F.struct(F.col("ord").alias("ord"), F.lower("term").alias("term"), given.alias("value"))).alias("_rule")))
    # one row per kind and length that occurs: bounded by the longest term
    sizes = terms.groupBy("_kind", F.length("_term").alias("len")).count().collect()
    cols = list(dict.fromkeys(col for col, _ in asked.values()))
    keys = {col: f"_text_{i}" for i, col in enumerate(cols)}
    cuts_of = sorted((i, r["_kind"], r["len"]) for i, (_, k) in enumerate(asked.values()) for r in sizes if kinds[r["_kind"] - 1] == k)
    if not cuts_of:
        return df.select("*", *[F.lit(None).cast("string").alias(out) for out in asked])
    keyed = df.select("*", *[F.lower(F.col(f"`{col}`")).alias(key) for col, key in keys.items()])
    texts = keyed.select(*keys.values()).distinct()
    text = F.lit(None).cast("string")
    for i, (col, _) in enumerate(asked.values()):
        text = F.when(F.col("_cut.number") == i, F.col(keys[col])).otherwise(text)
    size, room = F.col("_cut.len"), F.length("_text") - F.col("_cut.len") + 1
    every = F.array(*[F.struct(F.lit(i).alias("number"), F.lit(k).alias("kind"), F.lit(x).alias("len")) for i, k, x in cuts_of])
    cuts = (texts.select("*", F.explode(every).alias("_cut")).select("*", text.alias("_text")).where(room > 0)
            .select(*keys.values(), "_cut", "_text", F.explode(F.sequence(F.lit(1), room)).alias("_at"))
            .select(*keys.values(), F.col("_cut.number").alias("_number"), F.col("_cut.kind").alias("_kind"),
                    F.col("_text").substr(F.col("_at"), size).alias("_term")))
    few = sum(r["count"] for r in sizes) <= BROADCAST_TERMS
    first = (cuts.join(F.broadcast(terms) if few else terms, ["_kind", "_term"]).groupBy(*keys.values())
             .agg(*[F.min(F.when(F.col("_number") == i, F.col("_rule"))).getField("value").alias(out) for i, out in enumerate(asked)]))
    found = first.select(*[F.col(key).alias(f"{key}_") for key in keys.values()], *asked)
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"{key}_")) for key in keys.values()])
    return keyed.join(found, same, "left").select(*[F.col(f"`{c}`") for c in df.columns], *asked)


def first_rule(df: DataFrame, col: str, rules: DataFrame, out: str, value: str | None = None) -> DataFrame:
    """``df`` with ``out``: the ``value`` (default: the lower-cased term) of
    the first of ``rules(ord, term, …)`` whose term the text ``col`` contains,
    else NULL."""
    return first_rules(df, {out: (col, "")}, rules.withColumn("kind", F.lit("")), value)


def tag(text: Column) -> Column:
    """The tag of a file that contains the term ``text``."""
    return F.concat(text, F.lit(" data"))
