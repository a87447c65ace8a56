"""Mixing sources to target weights by Poisson replication (operator 4).

Every source gets a repetition rate, its target share of the whole divided by
its present size. A document of that source appears Poisson(rate) times: a
uniform number is taken from a hash of (seed, doc_id) and the distribution is
inverted on it, so the draw is the same in every run and on every retry, and
no task needs to know another's rows. The copies are then ordered by a hash of
(seed, doc_id, copy), a global shuffle that is repeatable too.

Rates above ``PART_RATE`` are drawn as a sum of Poisson parts (exact, and the
cumulative table of a part stays short). A source whose rate needs more than
``ROW_PARTS`` parts is drawn in blocks of so many: the draws hang on doc_id and
source alone, so each block is drawn once per pair by a task of its own, running
sums over a pair's blocks number the copies, and every (document, block) is
dealt to the tasks before its copies are made: however tiny a source is beside
the whole, no row or task makes more than a block's copies at once. The
per-source table is joined by broadcast only below ``BROADCAST_SOURCES`` rows,
else by a shuffled join.

Defined cases: null source is a source of its own; a document's size is its
UTF-8 bytes plus 1 (null text: 0 bytes), so a source of empty texts has a
size; sources without a weight get rate 0, weights of absent sources are
ignored and the rest rescaled; documents that repeat a doc_id share its
draw; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, quoted, staged, text_or_empty

PART_RATE = 64.0           # largest rate drawn by one inversion
ROW_PARTS = 16             # parts drawn, and their copies made, from one row
BROADCAST_SOURCES = 50_000  # sources that may be broadcast (about 40 MB)
DIGITS = 13                # hexadecimal digits (52 bits) of a uniform number


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long").cast("double")
            / F.lit(float(16 ** DIGITS)))


def _cumulative(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), … of Poisson(rate), until the rest is below 1e-16."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    first = F.exp(-rate)
    grown = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all")),
        lambda a, k: F.struct((a["p"] * rate / k).alias("p"), (a["c"] + a["p"] * rate / k).alias("c"),
                              F.concat(a["all"], F.array(a["c"] + a["p"] * rate / k)).alias("all")))
    return grown["all"]


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None,
                 source: str = "source", text: str = "text") -> DataFrame:
    """source, size, rate: bytes per source and its repetition rate. Without
    ``weights`` all sources weigh the same."""
    sizes = (docs.groupBy(quoted(source).alias("source"))
             .agg(F.sum(F.octet_length(text_or_empty(quoted(text))).cast("long") + 1).alias("size")))
    if weights is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))])
        weighed = sizes.withColumn("weight", F.coalesce(F.try_element_at(given, "source"), F.lit(0.0)))
    weighed = staged(weighed, "sources")
    all_size, all_weight = weighed.agg(F.sum("size").cast("double"), F.sum("weight")).first()
    if not all_weight:
        return weighed.select("source", "size", F.lit(0.0).alias("rate"))
    return weighed.select("source", "size", (F.col("weight") / all_weight * all_size / F.col("size")).alias("rate"))


def replicate(docs: DataFrame, weights: Mapping[str, float] | None = None, seed: int = 17,
              doc_id: str = "doc_id", source: str = "source", text: str = "text",
              extras: bool = True) -> DataFrame:
    """Each document as often as its draw says, globally shuffled. With
    ``extras`` the columns rate, copies, copy (64 bits, from 1) and shuffle_key
    (hex) follow those of ``docs``."""
    rates = source_rates(docs, weights, source, text)
    names = {n: free_name(docs, n) for n in (
        "rate", "copies", "copy", "shuffle_key", "mix_source", "mix_cdf", "mix_parts", "mix_id", "mix_block", "mix_before", "mix_here")}
    rate, copies, copy, key, src, cdf, parts, did, block, before, here = names.values()
    table = (rates.select(F.col("source").alias(src), F.col("rate").alias(rate),
                          F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).alias(parts))
             .withColumn(cdf, _cumulative(F.col(rate) / F.col(parts))))
    n_sources, most = rates.agg(F.count("*"), F.max("rate")).first()

    def joined(rows: DataFrame, source_col: Column, wanted: Column) -> DataFrame:
        side = table.where(wanted)
        return rows.join(F.broadcast(side) if n_sources <= BROADCAST_SOURCES else side, source_col.eqNullSafe(F.col(src)))

    def drawn(of: Column, first: Column, last: Column) -> Column:
        return F.aggregate(
            F.sequence(first, last), F.lit(0).cast("long"),
            lambda n, j: n + F.size(F.filter(F.col(cdf), lambda c: c <= uniform(F.lit(seed), of, j))))

    one_row = F.col(parts) <= ROW_PARTS
    spread = (joined(docs, quoted(source), one_row)
              .withColumn(copies, drawn(quoted(doc_id), F.lit(1).cast("long"), F.col(parts))).where(F.col(copies) > 0)
              .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))))
    if most is not None and most > PART_RATE * ROW_PARTS:
        # a pair (doc_id, source) has one row per block here, without its text
        pairs = joined(docs.select(quoted(doc_id).alias(did), quoted(source).alias("_source")), F.col("_source"), ~one_row)
        pairs = pairs.dropDuplicates([did, src])
        blocks = (pairs.select(did, src, rate, cdf, parts, F.explode(F.sequence(
                      F.lit(0).cast("long"), F.floor((F.col(parts) - 1) / ROW_PARTS))).alias(block))
                  .repartition(did, src, block)
                  .withColumn(here, drawn(F.col(did), F.col(block) * ROW_PARTS + 1,
                                          F.least((F.col(block) + 1) * ROW_PARTS, F.col(parts)))))
        pair = Window.partitionBy(did, src)
        blocks = (blocks.withColumn(before, F.sum(here).over(pair.orderBy(block)) - F.col(here))
                  .withColumn(copies, F.sum(here).over(pair)).where(F.col(here) > 0)
                  .select(did, src, rate, copies, block, before, here))
        dealt = (docs.join(blocks, quoted(doc_id).eqNullSafe(F.col(did)) & quoted(source).eqNullSafe(F.col(src)))
                 .repartition(did, src, block)
                 .withColumn(copy, F.explode(F.sequence(F.col(before) + 1, F.col(before) + F.col(here)))))
        kept = [*[quoted(c) for c in docs.columns], rate, copies, copy]
        spread = spread.select(*kept).union(dealt.select(*kept))
    spread = spread.withColumn(key, F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(quoted(doc_id).cast("string"), F.lit("null")),
                                                      F.lit("copy"), F.col(copy))))
    shuffled = spread.orderBy(key)
    return shuffled.select(*[quoted(c) for c in docs.columns], *([rate, copies, copy, key] if extras else []))


ORACLE_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1)::BIGINT AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, (1.0::DOUBLE / (SELECT count(*) FROM sizes)::DOUBLE) * (SELECT sum(size) FROM sizes)::DOUBLE / size AS rate
  FROM sizes),
parted AS (SELECT source, rate, greatest(ceil(rate / 64.0), 1)::INT AS parts FROM rates),
cdf AS (
  SELECT source, 0 AS k, rate / parts AS r, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS c,
         ceil(rate / parts + 12 * sqrt(rate / parts) + 30)::INT AS last FROM parted
  UNION ALL
  SELECT source, k + 1, r, p * r / (k + 1), c + p * r / (k + 1), last FROM cdf WHERE k < last),
steps AS (SELECT source, list(c ORDER BY k) AS cs FROM cdf GROUP BY source),
draws AS (
  SELECT d.doc_id, d.source, d.text, p.rate, unnest(range(1, p.parts + 1)) AS j
  FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source),
counts AS (
  SELECT w.doc_id, w.source, w.text, w.rate,
         sum(len(list_filter(s.cs, lambda x: x <= ('0x' || substr(md5('17|' || coalesce(w.doc_id::VARCHAR, 'null') || '|' || w.j), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)))::INT AS copies
  FROM draws w JOIN steps s ON w.source IS NOT DISTINCT FROM s.source GROUP BY ALL)
SELECT doc_id, source, round(rate, 6) AS rate, copies, copy,
       md5('17|' || coalesce(doc_id::VARCHAR, 'null') || '|copy|' || copy) AS shuffle_key,
       coalesce(strlen(text), 0)::INT AS n_bytes
FROM (SELECT *, unnest(range(1, copies + 1))::INT AS copy FROM counts WHERE copies > 0)
"""
