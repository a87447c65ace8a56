"""Language ID with interpolated Kneser-Ney character models (operator 3).

Per language, character n-grams of order ``ORDER`` are counted over all
training texts (tasks count their own rows first; the shuffle carries one row per
task, language and n-gram). Lower orders use continuation counts, all orders
are interpolated with absolute discounting. The union of all languages' n-grams
is kept as one sorted array of 64-bit hashes with a column of log probabilities per
language, so one binary search per character serves all languages; n-grams that no
language has seen are computed from the lower orders. The language of the lowest
cross-entropy per character wins.

Above ``MAX_GRAMS`` (language, n-gram) rows the same models stay tables in the
checkpoint folder (``Spread``): counts, totals, kinds and discounts are
aggregations over all counts, the most frequent n-grams' log probabilities are
broadcast, all other n-grams of a text meet theirs in a join. No n-gram is left out.

Rejection is calibrated on all training rows, each judged by a model that has not
seen it, that of the other half of the training rows: a text is rejected if its
cross-entropy lies above its language's mean by ``MARGIN`` times what these rows
show (as a multiple of 1/sqrt(characters), of ``STEADY`` at most). The same
rows calibrate the temperature of the score. Their figures stay a table; means,
maximum and fit are aggregations.

Characters: letters in lower case, all else is one blank between words; letters
beyond the basic plane share 4,096 symbols. Parameters: ``MAX_GRAMS`` bounds what
is broadcast. Counts and calibration cover all training rows.

Defined cases: null texts and texts without a letter are ``und`` (score 0,
rejected); rows without lang are not learned from; without any training row
all are ``und``; null doc_id counts as the empty text in the fold rule; equal
cross-entropies go to the alphabetically first language; long texts are read
whole; repeated rows are predicted again; an empty table gives no rows; further
columns are ignored (``identify``) or kept (``drop_unknown``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, quoted, received, send, staged, text_or_empty, worker_cache
from tidemark.session import ship_by_value

ORDER = 4
MAX_GRAMS = 2_000_000   # (language, n-gram) rows up to which the whole model is broadcast
STEADY = 1_000          # characters beyond which a text's cross-entropy varies no less
MARGIN = 2.0            # times the largest excess of the training rows
TEMPERATURES = [0.5, 1, 2, 4, 8, 16, 32, 64]
BLANK = 32
COUNT_AT = 250_000      # n-grams that wait in a task per language and half
SCORE_AT = 300_000      # characters scored at once in a task
ODD = np.uint64(0x9E3779B97F4A7C15)
S16 = np.uint64(16)
UNKNOWN = "und"


# ---- characters ----

def symbol_table() -> np.ndarray:
    """Code point → symbol: a lower-case letter, or BLANK."""
    cache = worker_cache()
    if "symbols" not in cache:
        table = np.full(0x110000, BLANK, np.uint16)
        for point in range(0x110000):
            if (char := chr(point)).isalpha():
                low = ord(char.lower()[0])
                table[point] = low if low < 0x10000 else 0xE000 + low % 0x1000
        cache["symbols"] = table
    return cache["symbols"]


def symbols_of(text: str) -> np.ndarray:
    """Symbols of a text, one blank between words, blanks around it; empty without a letter."""
    found = symbol_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = found == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first blank after a word stays
    found = found[keep]
    if len(found) and found[0] == BLANK:
        found = found[1:]
    if not len(found):
        return found
    tail = [] if found[-1] == BLANK else [BLANK]
    return np.concatenate([np.full(ORDER - 1, BLANK, np.uint16), found, np.array(tail, np.uint16)])


def grams_of(symbols: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each symbol, 16 bits a symbol, the newest lowest."""
    n = len(symbols) - ORDER + 1
    wide = symbols.astype(np.uint64)
    code = wide[:n].copy()
    for j in range(1, ORDER):
        code = (code << S16) | wide[j:j + n]
    return code


# ---- the models ----

def discount_of(once: int, twice: int) -> float:
    return min(max(once / (once + 2 * twice) if once and twice else 0.5, 0.05), 0.95)


class Language:
    """Interpolated Kneser-Ney model of one language from its n-gram counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.levels = {}
        codes, counts = codes.copy(), counts.astype(np.float64)
        for order in range(ORDER, 0, -1):
            at = np.argsort(codes * ODD, kind="stable")
            codes, counts = codes[at], counts[at]
            histories, where = np.unique((codes >> S16) * ODD, return_inverse=True)
            total = np.bincount(where, counts)
            kinds = np.bincount(where).astype(np.float64)
            discount = discount_of((counts == 1).sum(), (counts == 2).sum())
            self.levels[order] = (codes * ODD, counts, histories, total, kinds, discount)
            mask = np.uint64((1 << (16 * (order - 1))) - 1)
            codes, counts = np.unique(codes & mask, return_counts=True)  # in how many n-grams a shorter one continues
            counts = counts.astype(np.float64)
        self.alphabet = float(len(self.levels[1][0]) + 1)

    def probability(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """P(last symbol | the ones before) of n-grams of ``order`` symbols."""
        if order == 0:
            return np.full(len(codes), 1.0 / self.alphabet)
        lower = self.probability(codes & np.uint64((1 << (16 * (order - 1))) - 1), order - 1)
        grams, counts, histories, total, kinds, discount = self.levels[order]
        count, known = found_in(grams, codes * ODD, counts)
        history = (codes >> S16) * ODD
        all_count, seen = found_in(histories, history, total)
        different, _ = found_in(histories, history, kinds)
        all_count = np.where(seen, all_count, 1.0)
        return np.where(seen, (np.maximum(count - discount, 0.0) * known + discount * different * lower) / all_count, lower)


def found_in(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return np.where(hit, values[at], 0.0), hit


class Calibrated:
    """Names of the languages and what cross-entropies mean for them."""

    def __init__(self, names: list[str]):
        self.names = names
        self.temperature, self.mean, self.excess = 1.0, np.zeros(len(names)), np.inf

    def judge(self, sizes: np.ndarray, entropy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(language number or -1, score, cross-entropy, rejected) from symbols scored and cross-entropy per language."""
        best = np.argmin(entropy, axis=1)
        least = entropy[np.arange(len(entropy)), best]
        score = 1.0 / np.exp((least[:, None] - entropy) * self.temperature).sum(axis=1)
        rejected = (least - self.mean[best]) * np.sqrt(np.clip(sizes, 1, STEADY)) > MARGIN * self.excess
        none = sizes == 0
        return np.where(none, -1, best), np.where(none, 0.0, score), least, rejected | none

    def calibrate(self, judged: DataFrame) -> None:
        """From ``judged(number, size, entropy)``: language, symbols scored and cross-entropy per
        language (null where the model has none) of texts that the scoring model has not seen."""
        own, size = F.get("entropy", F.col("number")), F.col("size").cast("double")
        known = judged.where("size > 0").select("number", size.alias("size"), own.alias("own"), "entropy")

        def loss(t: float) -> Column:  # of the true language, at temperature t
            others = F.transform("entropy", lambda e: F.coalesce(F.exp((e - F.col("own")) * F.lit(-float(t))), F.lit(0.0)))
            return F.log(F.aggregate(others, F.lit(0.0), lambda a, b: a + b))

        totals = known.groupBy("number").agg(
            F.count(F.lit(1)).alias("n"), F.sum("own").alias("all_own"), F.sum("size").alias("symbols"), F.sum(F.col("own") * F.col("size")).alias("weighted"),
            F.array(*[F.sum(loss(t)) for t in TEMPERATURES]).alias("losses")).collect()  # one row per language
        if not totals:
            return
        plain = sum(r["all_own"] for r in totals) / sum(r["n"] for r in totals)
        means = {r["number"]: r["weighted"] / r["symbols"] for r in totals}
        self.mean = np.array([m if (m := means.get(i, 0.0)) > 0 else plain for i in range(len(self.names))])
        mean = F.get(F.array(*[F.lit(float(m)) for m in self.mean]), F.col("number"))
        excess = known.agg(F.max((F.col("own") - mean) * F.sqrt(F.least("size", F.lit(float(STEADY)))))).first()[0]
        self.excess = max(float(excess), 1.0)
        self.temperature = float(TEMPERATURES[int(np.argmin([sum(r["losses"][i] for r in totals) for i in range(len(TEMPERATURES))]))])


class Models(Calibrated):
    """All languages: sorted hashes of the n-grams, log probabilities per language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        super().__init__(sorted(counts))
        self.languages = [Language(*counts[name]) for name in self.names]
        union = np.unique(np.concatenate([counts[name][0] for name in self.names]))
        union = union[np.argsort(union * ODD, kind="stable")]
        self.keys = union * ODD
        self.logs = np.stack([np.log(x.probability(union)) for x in self.languages], axis=1)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols scored, cross-entropy per language) of each text."""
        sizes, result = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.names)))
        group, rows, held = [], [], 0
        for i, text in enumerate(texts):
            symbols = symbols_of(text) if text else ()
            if len(symbols) > SCORE_AT:  # a very long text, in slices
                codes = grams_of(symbols)
                sums = sum(self._logs(codes[a:a + SCORE_AT]).sum(axis=0) for a in range(0, len(codes), SCORE_AT))
                sizes[i], result[i] = len(codes), -sums / len(codes)
            elif len(symbols):
                group.append(grams_of(symbols))
                rows.append(i)
                held += len(group[-1])
            if held >= SCORE_AT:
                self._score(group, rows, sizes, result)
                group, rows, held = [], [], 0
        if group:
            self._score(group, rows, sizes, result)
        return sizes, result

    def _score(self, group, rows, sizes, result):
        lengths = np.array([len(g) for g in group])
        sums = np.add.reduceat(self._logs(np.concatenate(group)), np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0)
        sizes[rows] = lengths
        result[rows] = -sums / lengths[:, None]

    def _logs(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each n-gram in each language."""
        hashed = codes * ODD
        at = np.minimum(np.searchsorted(self.keys, hashed), len(self.keys) - 1)
        logs = self.logs[at]
        new = np.flatnonzero(self.keys[at] != hashed)
        if len(new):
            logs[new] = np.log(np.stack([x.probability(codes[new]) for x in self.languages], axis=1))
        return logs

    def decide(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(language number or -1, score, cross-entropy, rejected) of each text."""
        return self.judge(*self.entropies(texts))


# ---- the Spark plan ----

def remainder(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def _shipped() -> None:
    ship_by_value(sys.modules[__name__])
    ship_by_value(sys.modules[worker_cache.__module__])


def gram_counts(training: DataFrame) -> DataFrame:
    """(lang, half, gram, n) over all rows of ``training(lang, half, text)``."""
    _shipped()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}
        waiting: dict[tuple[str, int], int] = {}

        def fold(key) -> None:
            codes, where = np.unique(np.concatenate([c for c, _ in held[key]]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n for _, n in held[key]])).astype(np.int64)
            held[key], waiting[key] = [(codes, counts)], 0

        for batch in batches:
            for lang, half, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                symbols = symbols_of(text.as_py())
                if len(symbols):
                    codes, counts = np.unique(grams_of(symbols), return_counts=True)
                    held.setdefault((lang, half), []).append((codes, counts))
                    waiting[lang, half] = waiting.get((lang, half), 0) + len(codes)
                    if waiting[lang, half] >= COUNT_AT:
                        fold((lang, half))
        for key in held:
            fold(key)
            codes, counts = held[key][0]
            for a in range(0, len(codes), 100_000):
                part = codes[a:a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]] * len(part), pa.string()), pa.array([key[1]] * len(part), pa.int32()),
                     pa.array(part.view(np.int64)), pa.array(counts[a:a + 100_000])], ["lang", "half", "gram", "n"])

    return (training.select("lang", "half", "text").mapInArrow(counted, "lang string, half int, gram long, n long")
            .groupBy("lang", "half", "gram").agg(F.sum("n").alias("n")))


def _by_language(counts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The n-grams of each language, on the driver."""
    found = counts.toArrow()
    lang, gram, n = (found.column(c).combine_chunks() for c in ("lang", "gram", "n"))
    names, gram, n = np.array(lang.to_pylist(), object), gram.to_numpy().view(np.uint64), n.to_numpy()
    return {name: (gram[names == name], n[names == name]) for name in sorted(set(names))}


def _models(counts: DataFrame) -> Models | Spread | None:
    """The models of ``counts(lang, gram, n)``: on the driver up to MAX_GRAMS rows, else as tables."""
    if counts.count() > MAX_GRAMS:
        return Spread(counts)
    found = _by_language(counts)
    return Models(found) if found else None


class Spread(Calibrated):
    """The models of ``Language`` as tables: per order the counts of every n-gram and
    the total and kinds of every history, as arrays with one entry per language."""

    def __init__(self, counts: DataFrame):
        counts = staged(counts, "spread")
        super().__init__(sorted(r["lang"] for r in counts.select("lang").distinct().collect()))
        number = F.array_position(F.array(*[F.lit(name) for name in self.names]), F.col("lang")).cast("int") - 1
        rows = counts.select(number.alias("number"), "gram", F.col("n").cast("double").alias("n"))
        self.levels, self.histories, self.discounts = {}, {}, {}
        for order in range(ORDER, 0, -1):
            kinds = {r["number"]: r for r in rows.groupBy("number").agg(
                F.count(F.lit(1)).alias("all"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()}
            self.discounts[order] = [discount_of(kinds[i]["once"], kinds[i]["twice"]) for i in range(len(self.names))]
            self.alphabets = [float(kinds[i]["all"] + 1) for i in range(len(self.names))]  # of order 1 in the end
            self.levels[order] = staged(self._by_number(rows, "gram", "n"), f"level{order}")
            past = rows.groupBy("number", F.shiftrightunsigned("gram", 16).alias("history")).agg(
                F.sum("n").alias("total"), F.count(F.lit(1)).cast("double").alias("kinds"))
            self.histories[order] = staged(self._by_number(past, "history", "total", "kinds"), f"history{order}")
            rows = staged(rows.groupBy("number", _newest(F.col("gram"), order - 1).alias("gram"))
                          .agg(F.count(F.lit(1)).cast("double").alias("n")), f"order{order - 1}") if order > 1 else rows
        self.sent = send(counts.sparkSession, self._frequent(counts))

    def _by_number(self, rows: DataFrame, key: str, *values: str) -> DataFrame:
        """``rows(number, key, values)`` → key and an array by language of each value, 0 where a language has none."""
        entries = F.map_from_entries(F.collect_list(F.struct("number", F.struct(*values))))
        every = F.sequence(F.lit(0), F.lit(len(self.names) - 1))

        def dense(value: str) -> Column:
            return F.transform(every, lambda i: F.coalesce(F.try_element_at("entries", i)[value], F.lit(0.0)))

        return rows.groupBy(key).agg(entries.alias("entries")).select(key, *[dense(v).alias(v) for v in values])

    def logs(self, wanted: DataFrame) -> DataFrame:
        """(gram, logs by language) of the distinct n-grams ``wanted(gram)``."""
        every, none = F.sequence(F.lit(0), F.lit(len(self.names) - 1)), F.array_repeat(F.lit(0.0), len(self.names))
        needed = {ORDER: wanted}
        for order in range(ORDER - 1, 0, -1):
            needed[order] = needed[order + 1].select(_newest(F.col("gram"), order).alias("gram")).distinct()
        found = None
        for order in range(1, ORDER + 1):
            rows = (needed[order].withColumn("history", F.shiftrightunsigned("gram", 16))
                    .join(self.levels[order], "gram", "left").join(self.histories[order], "history", "left"))
            if order == 1:
                rows = rows.withColumn("lower", F.array(*[F.lit(1.0 / n) for n in self.alphabets]))
            else:
                rows = (rows.withColumn("suffix", _newest(F.col("gram"), order - 1))
                        .join(found.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix"))
            rows = rows.select("gram", "lower", *[F.coalesce(c, none).alias(c) for c in ("n", "total", "kinds")],
                               F.array(*[F.lit(d) for d in self.discounts[order]]).alias("d"))

            def chance(i: Column) -> Column:
                n, total, kinds, d, lower = (F.get(F.col(c), i) for c in ("n", "total", "kinds", "d", "lower"))
                return F.when(total > 0, (F.greatest(n - d, F.lit(0.0)) + d * kinds * lower) / total).otherwise(lower)

            found = rows.select("gram", F.transform(every, chance).alias("p"))
        return found.select("gram", F.transform("p", lambda p: F.log(p)).alias("logs"))

    def _frequent(self, counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(sorted hashes, log probabilities) of the most frequent n-grams, at most MAX_GRAMS figures."""
        totals = counts.groupBy("gram").agg(F.sum("n").alias("n"))
        size = F.floor(4 * F.log2("n"))
        room, least = MAX_GRAMS // len(self.names), None
        for r in totals.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():
            if (room := room - r["count"]) < 0:
                break
            least = r["size"]
        if least is None:
            return np.zeros(0, np.uint64), np.zeros((0, len(self.names)))
        found = self.logs(totals.where(size >= least).select("gram")).toArrow()
        keys = found.column("gram").combine_chunks().to_numpy().view(np.uint64) * ODD
        logs = found.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, len(self.names))
        at = np.argsort(keys, kind="stable")
        return keys[at], logs[at]

    def entropies(self, texts: DataFrame) -> DataFrame:
        """(key, symbols scored, cross-entropy per language) of ``texts(key, text)``, one row per key;
        texts of one key are equal."""
        sent, width = self.sent, len(self.names)

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def packed(rows, sums):
                key, size, gram, n = (np.concatenate(c) if c else np.zeros(0) for c in zip(*rows))
                return pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.string()), pa.array(size.astype(np.int64)), pa.array(sums, pa.list_(pa.float64())),
                     pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "size", "sums", "gram", "n"])

            for batch in batches:
                rows, sums, held = [], [], 0
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    keys, logs = received(sent)
                    text = text.as_py()
                    symbols = symbols_of(text) if text else ()
                    codes, n = np.unique(grams_of(symbols), return_counts=True) if len(symbols) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                    at = np.minimum(np.searchsorted(keys, codes * ODD), max(len(keys) - 1, 0))
                    hit = keys[at] == codes * ODD if len(keys) else np.zeros(len(codes), bool)
                    own = n[hit] @ logs[at[hit]] if hit.any() else np.zeros(width)
                    rest = codes[~hit]
                    # one row of what is known here (n is 0), then the n-grams that are looked up
                    rows.append((np.full(len(rest) + 1, key, object), np.concatenate([[n.sum()], np.zeros(len(rest), np.int64)]),
                                 np.concatenate([np.zeros(1, np.uint64), rest]), np.concatenate([[0], n[~hit]])))
                    sums += [own.tolist(), *[None] * len(rest)]
                    held += len(rest) + 1
                    if held >= COUNT_AT:
                        yield packed(rows, sums)
                        rows, sums, held = [], [], 0
                if held:
                    yield packed(rows, sums)

        pieces = staged(texts.select("key", "text").mapInArrow(split, "key string, size long, sums array<double>, gram long, n long"), "pieces")
        asked = pieces.where("n > 0")
        zero = F.lit(0).cast("long")
        looked_up = (asked.groupBy("key", "gram").agg(F.sum("n").alias("n")).join(self.logs(asked.select("gram").distinct()), "gram")
                     .select("key", zero.alias("size"), zero.alias("copies"), F.transform("logs", lambda x: x * F.col("n")).alias("sums")))
        known = pieces.where("n = 0").select("key", "size", F.lit(1).cast("long").alias("copies"), "sums")
        whole = known.union(looked_up).groupBy("key").agg(
            F.sum("size").alias("symbols"), F.sum("copies").alias("copies"),
            F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
        return whole.select("key", (F.col("symbols") / F.col("copies")).cast("long").alias("size"),
                            F.transform("sums", lambda x: -x / F.greatest("symbols", F.lit(1))).alias("entropy"))

    def decided(self, texts: DataFrame) -> DataFrame:
        """key, lang_pred, score, cross_entropy, rejected of ``texts(key, text)``, one row per key."""
        bare = Calibrated(self.names)
        bare.temperature, bare.mean, bare.excess = self.temperature, self.mean, self.excess

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    entropy = np.array(batch.column(2).to_pylist())
                    yield pa.RecordBatch.from_arrays([batch.column(0), *verdict(bare, *bare.judge(batch.column(1).to_numpy(), entropy))],
                                                     ["key", *VERDICT])

        return self.entropies(texts).mapInArrow(judged, f"key string, {VERDICT_TYPES}")


def _newest(gram: Column, order: int) -> Column:
    """The n-gram's last ``order`` symbols."""
    return gram.bitwiseAND(F.lit((1 << (16 * order)) - 1).cast("long"))


def _text_key(text: Column) -> Column:
    return F.md5(text_or_empty(text).cast("binary"))


VERDICT = ["lang_pred", "score", "cross_entropy", "rejected"]
VERDICT_TYPES = "lang_pred string, score double, cross_entropy double, rejected boolean"


def verdict(models: Calibrated, best: np.ndarray, score: np.ndarray, entropy: np.ndarray, rejected: np.ndarray) -> list[pa.Array]:
    names = [*models.names, UNKNOWN]
    return [pa.array([names[i] for i in best], pa.string()), pa.array(score), pa.array(entropy, mask=best < 0), pa.array(rejected)]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Models | Spread | None:
    """The calibrated models, learned from the rows that are not held out;
    None without any such row that has letters."""
    key = quoted(doc_id)
    training = (docs.select(key.alias("doc_id"), quoted(text).cast("string").alias("text"), quoted(lang).cast("string").alias("lang"))
                .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id")) != 2))
                .withColumn("half", (F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2))).cast("int")))
    counts = staged(gram_counts(training), "grams")
    models = _models(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    if models is None:
        return None
    judged = []
    for own in (0, 1):  # every training row, by the model of the half it is not in
        other = _models(counts.where(F.col("half") != own).select("lang", "gram", "n"))
        if other is not None:
            rows = training.where((F.col("half") == own) & F.col("lang").isin(*other.names)).select("lang", "text")
            judged.append(staged(_numbered(_entropies(rows, other), other.names, models.names), "judged"))
    if judged:
        models.calibrate(reduce(DataFrame.unionByName, judged))
    return models


def _numbered(judged: DataFrame, own: list[str], names: list[str]) -> DataFrame:
    """(number, size, entropy) among ``names`` of ``judged(lang, size, entropy)`` among the names ``own``."""
    at = {name: i for i, name in enumerate(own)}
    wide = F.array(*[F.get("entropy", F.lit(at[name])) if name in at else F.lit(None).cast("double") for name in names])
    number = F.array_position(F.array(*[F.lit(name) for name in names]), F.col("lang")).cast("int") - 1
    return judged.select(number.alias("number"), "size", wide.alias("entropy"))


def _entropies(rows: DataFrame, models: Models | Spread) -> DataFrame:
    """(lang, size, entropy) of every row of ``rows(lang, text)``."""
    if isinstance(models, Spread):
        keyed = rows.withColumn("key", _text_key(F.col("text")))
        return keyed.select("key", "lang").join(models.entropies(keyed), "key").select("lang", "size", "entropy")
    sent = send(rows.sparkSession, models)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, entropy = received(sent).entropies(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(list(entropy), pa.list_(pa.float64()))],
                                             ["lang", "size", "entropy"])

    return rows.mapInArrow(judged, "lang string, size long, entropy array<double>")


def identify(docs: DataFrame, models: Models | Spread | None = None, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected of every row."""
    _shipped()
    models = models or fit(docs, doc_id, text, lang)
    rows = docs.select(quoted(doc_id).alias("doc_id"), (remainder(quoted(doc_id)) == 2).alias("held_out"),
                       quoted(text).cast("string").alias("text"))
    if models is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    if isinstance(models, Spread):
        keyed = rows.withColumn("key", _text_key(F.col("text")))
        return keyed.drop("text").join(models.decided(keyed), "key").select("doc_id", "held_out", *VERDICT)
    sent = send(docs.sparkSession, models)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = received(sent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *verdict(found, *found.decide(batch.column(2).to_pylist()))],
                                             ["doc_id", "held_out", *VERDICT])

    return rows.mapInArrow(identified, f"doc_id {id_type}, held_out boolean, {VERDICT_TYPES}")


def drop_unknown(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` (all its columns) without the rows that identification rejects."""
    _shipped()
    models = fit(docs, doc_id, text, lang)
    if models is None:  # nothing to learn from: only texts without a letter are known to be rejected
        return docs.where(F.coalesce(quoted(text).cast("string"), F.lit("")).rlike(r"\p{L}"))
    if isinstance(models, Spread):
        key = free_name(docs, "key")
        keyed = docs.withColumn(key, _text_key(quoted(text)))
        rejected = models.decided(keyed.select(F.col(key).alias("key"), quoted(text).cast("string").alias("text"))).where("rejected")
        return keyed.join(rejected.select(F.col("key").alias(key)), key, "left_anti").select(*[quoted(c) for c in docs.columns])
    sent = send(docs.sparkSession, models)
    at = docs.columns.index(text)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(~received(sent).decide(batch.column(at).to_pylist())[3]))

    return docs.mapInArrow(known, docs.schema)
