"""Operator 2: language identification by interpolated Kneser-Ney models.

One character model per language, orders 1 to ``ORDER``. Letters are lower
case, everything else is one space between runs of letters. For a language,

    p(c | h) = max(a(hc) - D, 0) / a(h.) + D * t(h) / a(h.) * p(c | h')

with h' one character shorter, a(.) the count at the highest order and the
number of different preceding characters below it, t(h) the number of
different characters after h, D from the counts of ones and twos of the
order (n1 / (n1 + 2 n2)), and a uniform floor below order 1.

All models share one table per order: a sorted array of 64-bit n-gram hashes,
with every language's log10 probability in a row next to it, interpolation
already done, and of every context its log10 back-off weights. Characters of
a text are looked up together in numpy; a prefix index over the hashes leaves
a few steps of search per look-up.

The language with the lowest cross-entropy per character wins. ``score`` is
the winner's share of exp(-n * entropy / T) over all languages, T fitted
(by log loss) to documents kept out of the counts, for up to ``SPAN``
characters. A text is rejected (``rejected``, the prediction stays) if its
entropy is above the winner's ``QUANTILE`` over the same documents.

Learning reads all labelled rows to count characters per language; counts
come from a hash sample of about ``SAMPLE_CHARS`` characters per language,
whole texts; a language's documents of least hash are always counted, so every
language has counts. That bounds the model, so it is broadcast. The documents
put aside are measured in tasks; of each only its language, length and
entropies reach the driver.

Defined results: a null text, or one without a letter, is ``und`` with score
0 and not rejected; rows with a null language teach nothing; repeated rows
count as often as they come; with nothing to learn from all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, crc_remainder, table

ORDER = 5
SAMPLE_CHARS = 1_500_000   # characters per language the counts are taken from, about
CALIBRATION = 10           # one in so many sampled documents calibrates instead
QUANTILE = 0.999
SPAN = 200
BLOCK_CHARS = 1 << 19      # characters scored at a time
UNKNOWN = "und"
PREFIX_BITS = 18
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32


def _letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or a space."""
    out = np.full(0x110000, _SPACE, dtype=np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


_LETTERS: list[np.ndarray] = []


def letters_of(text: str) -> np.ndarray:
    """The text's letters in lower case with single spaces between runs, one
    space before and after; empty if there is no letter."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = np.concatenate([[np.uint32(_SPACE)], _LETTERS[0][points], [np.uint32(_SPACE)]])
    keep = (letters != _SPACE) | np.r_[True, letters[:-1] != _SPACE]
    letters = letters[keep]
    return letters if len(letters) > 2 else letters[:0]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MULTIPLY
    return h ^ (h >> np.uint64(29))


def gram_hashes(letters: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """For n = 1..order the hashes of the n-grams ending at each position
    (those that would begin before the text are of fewer characters)."""
    x = letters.astype(np.uint64)
    out = []
    so_far = np.zeros(len(x), dtype=np.uint64)
    for n in range(order):
        # n-gram = its last character, then the characters before it one by one
        before = np.concatenate([np.zeros(min(n, len(x)), dtype=np.uint64), x[:max(0, len(x) - n)]])
        so_far = _mixed(so_far * _MULTIPLY + before + np.uint64(n + 1))
        out.append(so_far)
    return out


@dataclass
class _Table:
    """Sorted hashes with a row of values each, behind a prefix index."""

    keys: np.ndarray
    values: np.ndarray
    index: np.ndarray = None
    steps: int = 0

    def __post_init__(self):
        self.index = np.searchsorted(self.keys >> np.uint64(64 - PREFIX_BITS),
                                     np.arange((1 << PREFIX_BITS) + 1)).astype(np.int32)
        longest = int(np.diff(self.index).max()) if len(self.keys) else 0
        self.steps = max(1, longest).bit_length()

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where it is missing."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        prefix = (hashes >> np.uint64(64 - PREFIX_BITS)).astype(np.int64)
        low, high = self.index[prefix], self.index[prefix + 1]
        end = high
        for _ in range(self.steps):  # halve the runs: first key not below the hash
            middle = (low + high) >> 1
            below = (middle < high) & (self.keys[np.minimum(middle, len(self.keys) - 1)] < hashes)
            low = np.where(below, middle + 1, low)
            high = np.where(below, high, middle)
        at = np.minimum(low, len(self.keys) - 1)
        return np.where((low < end) & (self.keys[at] == hashes), at, -1)


@dataclass
class Model:
    languages: list[str]
    grams: list[_Table]      # by order: log10 probabilities
    backoffs: list[_Table]   # by context length: log10 back-off weights
    floor: float
    temperature: float = 1.0
    limits: np.ndarray = None

    def log_probs(self, letters: np.ndarray, place: np.ndarray, owner: np.ndarray, n_owners: int,
                  scored: np.ndarray) -> np.ndarray:
        """(owners, languages) sums of the log10 probabilities of the letters
        at ``scored``. ``place``: a letter's position in its own text; its
        context never reaches before that text's first letter."""
        hashes = gram_hashes(letters)
        size = len(self.languages)
        total = np.zeros((n_owners, size))

        def add(at: np.ndarray, values: np.ndarray) -> None:
            for lang in range(size):
                total[:, lang] += np.bincount(owner[at], weights=values[:, lang], minlength=n_owners)

        todo = scored
        for order in range(ORDER, 0, -1):
            whole = place[todo] >= order - 1
            ready, later = todo[whole], todo[~whole]
            row = self.grams[order - 1].find(hashes[order - 1][ready])
            hit = row >= 0
            add(ready[hit], self.grams[order - 1].values[row[hit]])
            missed = ready[~hit]
            if order > 1 and len(missed):
                context = self.backoffs[order - 2].find(hashes[order - 2][missed - 1])
                known = context >= 0
                add(missed[known], self.backoffs[order - 2].values[context[known]])
            todo = np.concatenate([later, missed])
        return total + np.bincount(owner[todo], minlength=n_owners)[:, None] * self.floor

    def entropies(self, texts: list[str | None]) -> list[tuple[np.ndarray | None, int]]:
        """Of each text the cross-entropy per character (log10) by language,
        and the number of characters; None and 0 without a letter."""
        total = np.zeros((len(texts), len(self.languages)))
        chars = np.zeros(len(texts), dtype=np.int64)
        block: list[tuple[np.ndarray, int, int, int]] = []  # letters, first place, first scored, owner
        held = 0

        def flush():
            nonlocal block, held
            if block:
                sizes = [len(x) for x, _, _, _ in block]
                within = np.concatenate([np.arange(n) for n in sizes])
                first = np.repeat([f for _, f, _, _ in block], sizes)
                skip = np.repeat([k for _, _, k, _ in block], sizes)
                owner = np.repeat(np.arange(len(block)), sizes)
                sums = self.log_probs(np.concatenate([x for x, _, _, _ in block]), within + first, owner,
                                      len(block), np.flatnonzero(within >= skip))
                np.add.at(total, [i for _, _, _, i in block], sums)
            block, held = [], 0

        for i, text in enumerate(texts):
            letters = letters_of(text or "")
            if not len(letters) or not self.languages:
                continue
            chars[i] = len(letters) - 1
            at = 1
            while at < len(letters):  # pieces of a long text overlap by the context
                start = max(0, at - ORDER + 1)
                end = min(len(letters), at + BLOCK_CHARS - held)
                block.append((letters[start:end], start, at - start, i))
                held += end - start
                at = end
                if held >= BLOCK_CHARS:
                    flush()
        flush()
        return [(-total[i] / n, int(n)) if n else (None, 0) for i, n in enumerate(chars)]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        """language, score, cross-entropy per character in bits, rejected."""
        out = []
        for entropy, n in self.entropies(texts):
            if entropy is None:
                out.append((UNKNOWN, 0.0, None, False))
                continue
            best = int(np.argmin(entropy))
            weight = np.exp(-(entropy - entropy[best]) * min(n, SPAN) / self.temperature)
            out.append((self.languages[best], float(weight[best] / weight.sum()),
                        float(entropy[best] / np.log10(2)), bool(entropy[best] > self.limits[best])))
        return out


def estimate(counts: pd.DataFrame, languages: list[str]) -> Model:
    """Models from raw n-gram counts: columns ``lang`` (number), ``n``,
    ``gram`` (hash), ``context``, ``shorter`` (hashes of the n-gram without its
    last and without its first character) and ``count``."""
    size = len(languages)
    grams: list[_Table] = [None] * ORDER
    backoffs: list[_Table] = [None] * (ORDER - 1)
    by_order = {n: part for n, part in counts.groupby("n")}
    adjusted = {ORDER: by_order.get(ORDER, counts.iloc[:0])[["lang", "gram", "context", "shorter", "count"]]}
    for n in range(ORDER - 1, 0, -1):
        # number of different characters before each n-gram
        longer = by_order.get(n + 1, counts.iloc[:0])
        number = longer.groupby(["lang", "shorter"]).size().rename("kinds").reset_index()
        part = by_order.get(n, counts.iloc[:0]).merge(number, how="left", left_on=["lang", "gram"],
                                                      right_on=["lang", "shorter"], suffixes=("", "_of"))
        # an n-gram only seen at a text's beginning has none before it
        part["count"] = part["kinds"].fillna(1).astype(np.int64)
        adjusted[n] = part[["lang", "gram", "context", "shorter", "count"]]
    alphabet = max(2, counts.loc[counts["n"] == 1, "gram"].nunique() + 1)
    floor = -np.log10(alphabet)
    lower: _Table | None = None
    for n in range(1, ORDER + 1):
        part = adjusted[n]
        keys, column = np.unique(part["gram"].to_numpy(np.uint64), return_inverse=True)
        contexts, context = np.unique(part["context"].to_numpy(np.uint64), return_inverse=True)
        lang, count = part["lang"].to_numpy(), part["count"].to_numpy(np.float64)
        ones = np.bincount(lang, count == 1, minlength=size)
        twos = np.bincount(lang, count == 2, minlength=size)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        total = np.zeros((len(contexts), size))
        kinds = np.zeros((len(contexts), size))
        np.add.at(total, (context, lang), count)
        np.add.at(kinds, (context, lang), 1)
        seen = total > 0
        weight = np.where(seen, discount * kinds / np.where(seen, total, 1), 1.0)
        own = np.zeros((len(keys), size))
        own[column, lang] = (count - discount[lang]) / total[context, lang]
        of = np.zeros(len(keys), dtype=np.int64)
        of[column] = context
        if n == 1:
            below = np.full((len(keys), size), 10.0 ** floor)
        else:
            shorter = np.zeros(len(keys), dtype=np.uint64)
            shorter[column] = part["shorter"].to_numpy(np.uint64)
            below = 10.0 ** lower.values[lower.find(shorter)].astype(np.float64)
        lower = grams[n - 1] = _Table(keys, np.log10(own + weight[of] * below).astype(np.float32))
        if n == 1:
            floor = float(floor + np.log10(weight.mean())) if len(weight) else floor
        else:
            backoffs[n - 2] = _Table(contexts, np.log10(weight).astype(np.float32))
    return Model(languages, grams, backoffs, floor)


def calibrate(model: Model, found: list[tuple[int, int, np.ndarray]]) -> None:
    """Fits the temperature and the rejection limits to texts put aside: (number
    of the language, characters, entropies under each language)."""
    model.limits = np.full(len(model.languages), np.inf)
    if not found:
        return
    gaps = [(e - e.min()) * min(n, SPAN) for _, n, e in found]
    loss = lambda t: sum((g[lang] / t) + np.log(np.exp(-g / t).sum()) for (lang, _, _), g in zip(found, gaps))
    model.temperature = float(min(np.geomspace(0.05, 20, 40), key=loss))
    for lang in range(len(model.languages)):
        own = [e[lang] for k, n, e in found if k == lang and n >= 20]
        if own:
            model.limits[lang] = np.quantile(own, QUANTILE) * 1.05


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learns from every language of ``docs`` (leave held-out rows away)."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("language sample")), F.lit(1 << 30)).alias("h"))
    found = known.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"),
                                      F.min(F.when(F.length("text") > 0, F.col("h"))).alias("least")).collect()
    sizes = {r["lang"]: r["chars"] for r in found}
    least = {r["lang"]: -1 if r["least"] is None else r["least"] for r in found}
    languages = sorted(sizes)
    if not languages:
        return Model([], [], [], 0.0)
    number = {lang: i for i, lang in enumerate(languages)}
    below = {lang: int(min(1.0, sample_chars / max(sizes[lang], 1)) * (1 << 30)) for lang in languages}
    limit, first = (F.create_map(*[F.lit(x) for lang in languages for x in (lang, of[lang])]) for of in (below, least))
    is_first = F.col("h") == first[F.col("lang")]
    sample = (known.where(is_first | (F.col("h") < limit[F.col("lang")]))
              .withColumn("keep", ~is_first & (F.col("h") % CALIBRATION == 0)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                hashes, contexts, shorter = ([[] for _ in range(ORDER)] for _ in range(3))
                for text in texts:
                    letters = letters_of(text)
                    h = gram_hashes(letters)
                    for n in range(1, ORDER + 1):
                        at = np.arange(max(n - 1, 1), len(letters))
                        hashes[n - 1].append(h[n - 1][at])
                        contexts[n - 1].append(h[n - 2][at - 1] if n > 1 else np.zeros(len(at), np.uint64))
                        shorter[n - 1].append(h[n - 2][at] if n > 1 else np.zeros(len(at), np.uint64))
                for n in range(1, ORDER + 1):
                    keys, first, many = np.unique(np.concatenate(hashes[n - 1]), return_index=True, return_counts=True)
                    if len(keys):
                        yield pd.DataFrame({
                            "lang": np.int32(number[lang]), "n": np.int32(n), "gram": keys.view(np.int64),
                            "context": np.concatenate(contexts[n - 1])[first].view(np.int64),
                            "shorter": np.concatenate(shorter[n - 1])[first].view(np.int64), "count": many})

    counted = (sample.where("not keep").select("lang", "text")
               .mapInPandas(count, "lang int, n int, gram long, context long, shorter long, count long")
               .groupBy("lang", "n", "gram", "context", "shorter").agg(F.sum("count").alias("count")).toPandas())
    for name in ("gram", "context", "shorter"):
        counted[name] = counted[name].to_numpy(np.int64).view(np.uint64)
    model = estimate(counted.sort_values(["lang", "n", "gram"], ignore_index=True), languages)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            measured = shared.value.entropies(batch["text"].tolist())
            kept = [(number[lang], n, e) for lang, (e, n) in zip(batch["lang"], measured) if n]
            yield pd.DataFrame(kept, columns=["lang", "n", "entropies"])

    aside = sample.where("keep").select("lang", "text").mapInPandas(measure, "lang int, n long, entropies array<double>")
    calibrate(model, [(lang, n, np.array(e)) for lang, n, e in sorted(tuple(r) for r in aside.collect())])
    shared.destroy()
    return model


def predictions(spark: SparkSession, model: Model, text: Column) -> Column:
    """struct<lang_pred, score, entropy, rejected> of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, entropy double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(shared.value.predict([t if isinstance(t, str) else None for t in batch]),
                               columns=["lang_pred", "score", "entropy", "rejected"])

    return predict(text)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(crc_remainder(F.col("doc_id"), 5) != 0))
    return (docs.select("doc_id", "text").withColumn("found", predictions(spark, model, F.col("text")))
            .select("doc_id", F.coalesce(crc_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                    "found.*"))
