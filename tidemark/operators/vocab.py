"""Vocabulary operators: graph pattern over triples (JOIN-7), vocabulary
merge (JOIN-8, VOC-2), and the matching cascade (VOC-1: JOIN-3..6,
WIN-6, AGG-9, AGG-11).

Matching runs once per DISTINCT variable name and is joined back to the
datasets. Exact and ignore-case stages are equi-joins. Fuzzy stage 1 is an
equi-join on a computed key; fuzzy stage 2 (every token contained in the
label) is an equi-join of a name's RAREST gram with an index of the labels'
grams, and a test of the whole rule. Names that are one gram are
answered from the index alone: their hits are a count, and their list holds at
most as many labels as the caller asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# Predicate patterns of the vocabulary graph (the
# definition predicate is spelled "Defintion" in the source graph).
PREDICATES = {"definition": "/Defintion", "label": "/Term", "details": "/Reference",
              "section": "/Section"}
RDFS_LABEL = "rdfs:label"
KINDS = ["verbatim", "ignore_case", "fuzzy", "nonunique", "no_match"]


def triple_pattern(triples: DataFrame, identifier_rx: str = "(?i)ioos",
                   require_predicate_label: bool = False,
                   label_filter: Column | None = None) -> DataFrame:
    """JOIN-7: subjects carrying all four predicates -> one row per
    combination of their values (multi-valued predicates multiply rows,
    as a graph query does). ``require_predicate_label`` adds the fuzzy
    form's condition that the definition predicate has an rdfs:label."""
    roles = F.filter(F.array(*[F.when(F.col("p").rlike(rx), F.lit(name)) for name, rx in PREDICATES.items()]), lambda r: r.isNotNull())
    t = triples.where(F.col("s").rlike(identifier_rx)).select(F.col("s").alias("identifier"), "p", "o", F.explode(roles).alias("role"))
    # one scan, one shuffle: a subject's values by role, then their combinations.
    # A subject without all four roles goes before anything is multiplied.
    lists = [F.collect_list(F.when(F.col("role") == name, F.struct("p", "o") if name == "definition" else F.col("o"))).alias(name)
             for name in PREDICATES]
    j = t.groupBy("identifier").agg(*lists)
    j = j.where(F.expr(" AND ".join(f"size({name}) > 0" for name in PREDICATES)))
    for name in PREDICATES:
        j = j.withColumn(name, F.explode(name))
    j = j.select("identifier", F.col("definition.p").alias("p_definition"), F.col("definition.o").alias("definition"), "label", "details", "section")
    if require_predicate_label:
        pl = triples.where(F.col("p") == RDFS_LABEL).select(F.col("s").alias("p_definition"))
        j = j.join(pl, on="p_definition", how="inner")
    out = j.select("label", "identifier", "section", "definition", "details")
    if label_filter is not None:
        out = out.where(label_filter)
    return out


PAGE_STEP = 10 ** 18  # above any term number; page and number share one decimal(38)


def vocab_from_attrs(attrs: DataFrame) -> DataFrame:
    """(page_id, seq, ord, term, attr, value) rows -> vocab(term, ord, attrs
    map). ``ord`` is page_id * ``PAGE_STEP`` + seq, a decimal that no page
    size makes overlap.

    A term defined more than once keeps the attributes of its LAST
    definition (``seq``) and the position of its first (``ord``); the
    last definition per term is found with a partial aggregate before
    any attribute is collected, so a hot term never gathers all of its
    occurrences in one task."""
    attrs = attrs.withColumn("seq", (F.col("page_id").cast("decimal(19,0)") * F.lit(PAGE_STEP).cast("decimal(19,0)")
                                     + F.col("seq")).cast("decimal(38,0)"))
    last = attrs.groupBy("term").agg(F.max("seq").alias("seq"), F.min("seq").alias("first_seq"))
    keep = attrs.join(last, on=["term", "seq"], how="inner")
    # a repeated attribute keeps its first position and its last value
    keep = keep.groupBy("term", "seq", "first_seq", "attr").agg(
        F.min("ord").alias("ord"), F.max_by("value", "ord").alias("value"))
    return (keep.groupBy("term", "first_seq")
                .agg(F.array_sort(F.collect_list(F.struct("ord", "attr", "value"))).alias("_a"))
                .select("term", F.col("first_seq").alias("ord"),
                        F.map_from_entries(F.transform("_a", lambda x: F.struct(x["attr"], x["value"])))
                        .alias("attrs")))


def merge_vocab(a: DataFrame, b_results: DataFrame, ignore_case: bool = False,
                order_cols: tuple[str, ...] = ("identifier", "definition", "details", "section")
                ) -> DataFrame:
    """JOIN-8 / VOC-2: keep vocabulary ``a`` (term, ord, attrs); add each
    graph result label (lower-cased) that is not an ``a`` term (the test
    is case-sensitive unless ``ignore_case``); a label bound several times
    keeps its first result in ``order_cols`` order; attributes follow the
    key order of ``a``'s first term ('' when the result lacks one), then
    the result's other keys; values lower-cased."""
    # key order of the first local term: one small array, fetched once
    # (the vocabulary is cut from its lineage first, so it is built once)
    a = cut_lineage(a)
    first = a.select(F.min_by(F.map_keys("attrs"), "ord")).first()[0] or []
    keys = F.array(*[F.lit(k.lower()) for k in first]).cast("array<string>")
    other = [c for c in ("identifier", "section", "definition", "details") if c in b_results.columns]
    b = b_results.withColumn("term", F.lower("label"))
    probe = F.lower(a["term"]) if ignore_case else a["term"]
    a_terms = a.select(probe.alias("term")).distinct()
    new = (b.join(a_terms, on="term", how="left_anti")
            .groupBy("term")
            .agg(F.min_by(F.struct(*other), F.struct(*order_cols)).alias("r"),
                 F.min(F.struct(*order_cols)).alias("o"))
            .select("term", "r.*"))
    bmap = F.map_from_arrays(F.array(*[F.lit(c) for c in other]),
                             F.array(*[F.lower(F.col(c)) for c in other]))
    head = F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.coalesce(F.try_element_at(bmap, k),
                                                                                  F.lit("")))))
    rest = F.map_filter(bmap, lambda k, v: ~F.array_contains(keys, k))
    added = new.select("term", F.lit(None).cast("decimal(38,0)").alias("ord"),
                       F.map_concat(head, rest).alias("attrs"), F.lit("graph").alias("source"))
    return a.select("term", F.col("ord").cast("decimal(38,0)").alias("ord"), "attrs",
                    F.lit("local").alias("source")).unionByName(added)


def _tokens(name: Column) -> Column:
    return F.split(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), "_", -1)


GRAM = 3  # characters of a gram; a shorter token is its own gram


def _label_grams(labels: DataFrame) -> DataFrame:
    """(label, mult, low, g): the distinct grams of one to ``GRAM`` characters of every label."""
    low = labels.select("label", "mult", F.lower("label").alias("low")).where(F.length("low") > 0)
    pos = low.select("label", "mult", "low", F.explode(F.sequence(F.lit(1), F.length("low"))).alias("i"))
    return pos.select("label", "mult", "low",
                      F.explode(F.array(*[F.substring("low", F.col("i"), n) for n in range(1, GRAM + 1)])).alias("g")).distinct()


def _tested_names(names: DataFrame) -> DataFrame:
    """(name, toks, single): names with a real token, their distinct lower-case
    tokens, and the token if it is the only one and no longer than a gram."""
    real = F.array_distinct(F.filter(F.transform(_tokens(F.col("name")), lambda t: F.lower(t)), lambda t: F.length(t) > 0))
    first = F.try_element_at("toks", F.lit(1))
    return (names.select("name", real.alias("toks")).where(F.size("toks") > 0)
            .withColumn("single", F.when((F.size("toks") == 1) & (F.length(first) <= GRAM), first)))


def _rarest_gram(tested: DataFrame, grams: DataFrame) -> DataFrame:
    """(name, toks, g, n): the gram of a name that the fewest labels hold, and
    their number. Names with a gram that no label holds match nothing and go."""
    grams_of = F.array_distinct(F.flatten(F.transform("toks", lambda t: F.when(F.length(t) <= GRAM, F.array(t)).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(t) - GRAM + 1), lambda i: F.substring(t, i, F.lit(GRAM)))))))
    held = grams.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    sought = tested.select("name", "toks", F.explode(grams_of).alias("g")).join(held, "g", "left")
    n = F.coalesce("n", F.lit(0))
    return (sought.groupBy("name", "toks").agg(F.min(F.struct(n.alias("n"), F.col("g"))).alias("r"))
            .where("r.n > 0").select("name", "toks", "r.g", "r.n"))


def _stage2_pairs(names: DataFrame, labels: DataFrame, singles: bool = True) -> DataFrame:
    """(name, label, mult) where every token of the name is contained
    (case-insensitive) in the label; ``labels`` holds distinct labels with
    their multiplicity. Empty tokens are contained in every label (S7) and
    so need no test; names without any other token are left to
    :func:`_all_labels`, and, without ``singles``, names that are one gram to
    :func:`_single_grams`.

    One plan for every size: a label that contains all tokens contains all
    their grams, so an equi-join on the rarest of them finds all pairs, and
    the whole rule is tested on each."""
    tested = _tested_names(names)
    tested = tested if singles else tested.where(F.col("single").isNull())
    grams = _label_grams(labels)
    return (_rarest_gram(tested, grams).join(grams, "g").where(F.forall("toks", lambda t: F.instr(F.col("low"), t) > 0))
            .select("name", "label", "mult"))


def _single_grams(names: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """(name, hits, labels) of names that are one gram: hits are the gram's
    count, labels the first ``k`` that hold it. Names and labels are never paired."""
    tested = _tested_names(names).where(F.col("single").isNotNull())
    grams = _label_grams(labels)
    first = Window.partitionBy("g").orderBy("label")
    held = grams.groupBy("g").agg(F.sum("mult").alias("hits"))
    few = (grams.join(tested.select(F.col("single").alias("g")).distinct(), "g", "left_semi")
           .withColumn("place", F.row_number().over(first)).where(F.col("place") <= k))
    some = few.groupBy("g").agg(_listed(k).alias("labels"))
    return (tested.select("name", F.col("single").alias("g")).join(held, "g").join(some, "g")
            .select("name", "hits", "labels"))


def _listed(k: int | None) -> Column:
    """Labels of a group in order, each as often as it is bound; the first ``k``."""
    times = F.col("mult") if k is None else F.least("mult", F.lit(k).cast("long"))
    every = F.array_sort(F.flatten(F.collect_list(F.when(F.col("label") == "*", F.array("label")).otherwise(
        F.transform(F.sequence(F.lit(1).cast("long"), times), lambda i: F.col("label"))))))
    return every if k is None else F.slice(every, 1, k)


def _all_labels(names: DataFrame, labels: DataFrame) -> DataFrame:
    """One row (name, label ``*``, mult, only) for each name of special
    characters alone: every label matches (S7), so it gets their total
    number instead of name x label pairs; ``only`` is the label if there is
    a single one."""
    bare = names.where(F.length(F.regexp_replace("name", "[^A-Za-z0-9]+", "")) == 0)
    total = labels.agg(F.coalesce(F.sum("mult"), F.lit(0)).alias("mult"), F.min("label").alias("only"))
    one = total.first()  # two values
    return (bare.select("name", F.lit("*").alias("label"), F.lit(one["mult"]).cast("long").alias("mult"),
                        F.lit(one["only"]).cast("string").alias("only")).where(F.col("mult") > 0))


def match_names(names: DataFrame, vocab: DataFrame, candidates: DataFrame, max_candidates: int | None = None) -> DataFrame:
    """VOC-1 for distinct ``names`` (column ``name``): kind, matched term
    and candidate labels, following verbatim -> ignore_case -> fuzzy
    stage 1 (special characters removed, lower-case equality) -> stage 2
    (all tokens contained) with unique / nonunique / no_match (S7).
    ``hits`` counts the candidate results. A name of special characters
    alone matches every label: its ``candidates`` is the one entry ``*``
    and ``hits`` their number.

    ``vocab``: (term, ord, ...); ``candidates``: graph results (label, ...),
    one row per result (a label bound twice counts as two hits).
    With ``max_candidates`` a name's list holds that many labels at most, and no
    more are ever gathered (``hits`` still counts all; :func:`candidate_rows`
    has the rest in long form); without it the list is whole.
    Matching uses the fixed vocabulary; fuzzy hits are returned, not
    added to it (order-independent). Exact and ignore-case matches come
    from ONE join on the lower-cased name against the terms grouped by
    their lower-cased form (the spellings of one term, and the last one
    for the dictionary semantics of the ignore-case lookup)."""
    n = names.select("name").distinct()
    lt = (vocab.groupBy(F.lower("term").alias("low"))
               .agg(F.collect_set("term").alias("spellings"), F.max_by("term", "ord").alias("last")))
    a = n.join(lt, F.lower(n["name"]) == lt["low"], "left")
    exact = F.coalesce(F.array_contains("spellings", F.col("name")), F.lit(False))
    a = a.select("name",
                 F.when(exact, F.lit("verbatim")).when(F.col("low").isNotNull(), F.lit("ignore_case"))
                 .alias("kind_a"),
                 F.when(exact, F.col("name")).when(F.col("low").isNotNull(), F.col("last")).alias("term_a"))
    # The distinct names and the distinct labels are written once to the
    # shared checkpoint folder; the later stages read them back instead of
    # recomputing them.
    a = cut_lineage(a)
    rest = a.where(F.col("kind_a").isNull()).select("name")

    labels = cut_lineage(candidates.groupBy("label").agg(F.count("*").alias("mult")))
    key1 = F.lower(F.regexp_replace("name", "[^A-Za-z0-9]+", ""))
    s1 = rest.withColumn("k", key1).join(labels.withColumn("k", F.lower("label")), on="k") \
        .select("name", "label", "mult", F.lit(1).alias("stage"))
    only = F.lit(None).cast("string").alias("only")
    s2 = _stage2_pairs(rest, labels, singles=max_candidates is None).withColumn("stage", F.lit(2))
    every = _all_labels(rest, labels).withColumn("stage", F.lit(2))
    found = s1.select("*", only).unionByName(s2.select("*", only)).unionByName(every)
    hits = [F.sum("mult").alias("hits"), F.max("only").alias("only")]
    if max_candidates is None:
        per_stage = found.groupBy("name", "stage").agg(*hits, _listed(None).alias("labels"))
    else:
        first = Window.partitionBy("name", "stage").orderBy("label")
        some = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= max_candidates)
        per_stage = (found.groupBy("name", "stage").agg(*hits)
                     .join(some.groupBy("name", "stage").agg(_listed(max_candidates).alias("labels")), ["name", "stage"])
                     .unionByName(_single_grams(rest, labels, max_candidates).select("name", F.lit(2).alias("stage"), "hits", only, "labels")))
    # WIN-6: stop at a unique hit, otherwise the stage with most hits (earlier on ties)
    best = per_stage.groupBy("name").agg(F.max_by(
        F.struct("stage", "hits", "labels", "only"),
        F.struct((F.col("hits") == 1).alias("u"), F.col("hits"), (-F.col("stage")).alias("s"))).alias("b"))
    j = a.join(best, on="name", how="left")
    unique = F.col("b.hits") == 1
    kind = (F.when(F.col("kind_a").isNotNull(), F.col("kind_a"))
             .when(unique, F.lit("fuzzy")).when(F.col("b").isNotNull(), F.lit("nonunique"))
             .otherwise(F.lit("no_match")))
    term = F.when(F.col("kind_a").isNotNull(), F.col("term_a")).when(
        unique, F.coalesce(F.col("b.only"), F.try_element_at(F.col("b.labels"), F.lit(1))))
    fuzzy = F.col("kind_a").isNull() & F.col("b").isNotNull()
    return j.select("name", kind.alias("kind"), term.alias("term"),
                    F.when(fuzzy, F.col("b.labels")).otherwise(F.array().cast("array<string>")).alias("candidates"),
                    F.when(fuzzy, F.col("b.hits")).otherwise(F.lit(0)).cast("long").alias("hits"),
                    F.when(fuzzy, F.col("b.stage")).otherwise(F.lit(0)).alias("stage"))


def candidate_rows(names: DataFrame, candidates: DataFrame) -> DataFrame:
    """(name, stage, label, mult): every candidate of every name in long form;
    no list is gathered. Names of special characters alone get the row ``*``."""
    n = names.select("name").distinct()
    labels = candidates.groupBy("label").agg(F.count("*").alias("mult"))
    key = F.lower(F.regexp_replace("name", "[^A-Za-z0-9]+", ""))
    s1 = n.withColumn("k", key).join(labels.withColumn("k", F.lower("label")), "k").select("name", F.lit(1).alias("stage"), "label", "mult")
    s2 = _stage2_pairs(n, labels).select("name", F.lit(2).alias("stage"), "label", "mult")
    return s1.unionByName(s2).unionByName(_all_labels(n, labels).select("name", F.lit(2).alias("stage"), "label", "mult"))


def match_variables(variables: DataFrame, vocab: DataFrame, candidates: DataFrame, max_candidates: int | None = None) -> DataFrame:
    """Match distinct names once, join the result back to (dataset, name)."""
    m = match_names(variables.select("name"), vocab, candidates, max_candidates)
    return variables.join(m, on="name", how="left")


FUZZY_COMMENT = "taken from the one vocabulary entry that fits the name"


def revised_vocabulary(matches: DataFrame, vocab: DataFrame, candidates: DataFrame) -> DataFrame:
    """SNK-4: (term, ord, attrs, source), the vocabulary after matching: the label of
    every unique fuzzy hit becomes a term (in place of a term of the same
    spelling) with the result's attributes, those of the first local term's
    keys first, then ``label``, the others and a ``comment``."""
    others = [c for c in ("identifier", "section", "definition", "details") if c in candidates.columns]
    first = vocab.select(F.min_by(F.map_keys("attrs"), "ord")).first()[0] or []  # one small array
    keys = [k.lower() for k in first if k.lower() in others]
    order = [*keys, "label", *[c for c in others if c not in keys]]
    entry = F.map_from_arrays(F.array(*[F.lit(c) for c in (*order, "comment")]),
                              F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order], F.lit(FUZZY_COMMENT)))
    hit = matches.where(F.col("kind") == "fuzzy").select(F.col("term").alias("label")).distinct()
    new = hit.join(candidates, "label").select(F.col("label").alias("term"), F.lit(None).cast("decimal(38,0)").alias("ord"),
                                               entry.alias("attrs"), F.lit("fuzzy").alias("source"))
    kept = vocab.join(hit.select(F.col("label").alias("term")), "term", "left_anti")
    return kept.select("term", F.col("ord").cast("decimal(38,0)").alias("ord"), "attrs", F.lit("local").alias("source")).unionByName(new)


def match_counts(matches: DataFrame) -> DataFrame:
    """AGG-9: per dataset, counts of every match kind."""
    return (matches.groupBy("dataset").pivot("kind", KINDS).count().na.fill(0, subset=KINDS)
                   .select("dataset", *[F.col(k).cast("long").alias(k) for k in KINDS]))


def missing_labels(matches: DataFrame) -> DataFrame:
    """AGG-11: each unmatched name once, with how many datasets lack it
    and the first of them (a name can be missing from millions of
    datasets, so the full list stays long-form: :func:`missing_label_datasets`)."""
    return (matches.where(F.col("kind") == "no_match").groupBy("name")
                   .agg(F.count_distinct("dataset").alias("n_datasets"),
                        F.min("dataset").alias("first_dataset")))


def missing_label_datasets(matches: DataFrame) -> DataFrame:
    """(name, dataset) for every unmatched variable (long form)."""
    return matches.where(F.col("kind") == "no_match").select("name", "dataset").distinct()
