"""Language identification by words, then by shorter and shorter character n-grams (operator 9)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .scratch import Scratch

TRAIN_ROWS = 20_000
MODEL_WORDS = 150_000
MODEL_GRAMS = 50_000
LONGEST_GRAM = 5
CACHE_WORDS = 100_000
SLICE_ROWS = 1024
SMOOTHING = 0.5
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; none if the text has no letter."""
    words = WORD.findall((text or "").lower())
    return words if any(c.isalpha() for w in words for c in w) else []


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def held_out(doc_id: Column) -> Column:
    """Whether CRC-32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


class LanguageModel:
    """Log frequencies by language of words and of their character n-grams.

    A known word scores by itself. Any other scores by the mean of its known n-grams of the greatest
    length that has any; one without any known letter counts for nothing. What a language has not shown has the same small
    frequency in all of them, so that one learned from little text does not draw the unseen words of others.
    """

    def __init__(self, languages: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray], totals: dict[int, np.ndarray]) -> None:
        self.languages = languages
        self.cache: dict[str, int] = {}
        self.rows = np.zeros((1024, len(languages)), np.float32)
        self.places: list[dict[str, int]] = []
        self.logs: list[np.ndarray] = []
        for n in range(LONGEST_GRAM + 1):
            own = {g: c for g, c in grams.items() if len(g) == n} if n else words
            shares = np.array(list(own.values())).reshape(len(own), len(languages)) / totals[n]
            logs = np.log(shares + SMOOTHING / totals[n].max(initial=1))
            self.places.append({g: i for i, g in enumerate(own)})
            self.logs.append((logs - logs.max(axis=1, keepdims=True, initial=-np.inf)).astype(np.float32))

    def word(self, word: str) -> np.ndarray:
        known = self.places[0].get(word)
        if known is not None:
            return self.logs[0][known]
        for n in range(min(LONGEST_GRAM, len(word) + 2), 0, -1):
            found = [at for g in grams_of(word, n) if (at := self.places[n].get(g)) is not None]
            if found:
                return self.logs[n][found].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)

    def _known(self, words: list[str]) -> list[int]:
        """The rows of ``self.rows`` with the scores of the words."""
        cache = self.cache
        for w in set(words):
            if w not in cache:
                if len(cache) == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.rows[len(cache)] = self.word(w)
                cache[w] = len(cache)
        return [cache[w] for w in words]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its share of the probability, all languages being alike before the text is seen."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        labels, shares = [], []
        for text in texts:
            words = words_of(text)
            if not words or not self.languages:
                labels.append(UNKNOWN)
                shares.append(0.0)
                continue
            known = self._known(words)
            total = self.rows[known].sum(axis=0, dtype=np.float64)
            p = np.exp(total - total.max())
            best = int(p.argmax())
            labels.append(self.languages[best])
            shares.append(float(min(1.0, p[best] / p.sum())))
        return labels, shares


def shares(counts: dict[str, int], rows: int) -> dict[str, float]:
    """The share of each language's rows to learn from: all of a rare one, and of the others equal numbers, about ``rows`` together."""
    out, left = {}, rows
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(1.0, max(1.0, left / (len(counts) - i)) / n)
        left -= out[lang] * n
    return out


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fit on about ``rows`` rows of ``text, lang, doc_id`` with a language, drawn by a hash; fewer are all taken.

    Each language has its own share of the rows, of the words and of the n-grams, so a rare one is learned beside a frequent one.
    The counts are summed on the cluster. The driver and each task hold ``MODEL_WORDS`` words at most and
    ``MODEL_GRAMS`` of each length of n-gram, or one of each language, whatever the size of the corpus: the most frequent of each language.
    """
    labelled = docs.where("lang IS NOT NULL")
    own = shares({r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}, rows)
    spark, slots = docs.sparkSession, 1_000_003
    drawn = spark.createDataFrame([(lang, int(share * slots) + 1) for lang, share in own.items()], "lang string, drawn long")
    slot = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(slots))
    sample = labelled.join(F.broadcast(drawn), "lang").where(slot < F.col("drawn"))  # a row for each language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.update((w, lang) for w in words_of(text))
        grams: Counter = Counter()
        for (w, lang), n in words.items():
            grams[w, 0, lang] += n
            for k in range(1, LONGEST_GRAM + 1):
                for g in grams_of(w, k):
                    grams[g, k, lang] += n
        keys = list(grams)
        for at in range(0, len(keys), 100_000):
            part = keys[at : at + 100_000]
            yield pa.record_batch([pa.array([k[0] for k in part], pa.string()), pa.array([k[1] for k in part], pa.int32()), pa.array([k[2] for k in part], pa.string()), pa.array([grams[k] for k in part], pa.int64())], ["gram", "size", "lang", "n"])

    counted = sample.select("text", "lang").mapInArrow(count, "gram string, size int, lang string, n long").groupBy("gram", "size", "lang").agg(F.sum("n").alias("n"))
    scratch = Scratch(docs.sparkSession, "language")
    counted = scratch.keep(counted, "counts")
    quota = F.when(F.col("size") > 0, max(1, MODEL_GRAMS // max(1, len(own)))).otherwise(max(1, MODEL_WORDS // max(1, len(own))))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("size", "lang").orderBy(F.desc("n"), "gram")))
    best = scratch.keep(ranked.where(F.col("rank") <= quota).select("gram", "size").distinct(), "best")
    table = counted.join(best, ["gram", "size"], "left_semi").groupBy("gram", "size").agg(F.collect_list(F.struct("lang", "n")).alias("by"))
    totals = counted.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in totals})
    at = {lang: i for i, lang in enumerate(languages)}
    sums = {n: np.ones(len(languages)) for n in range(LONGEST_GRAM + 1)}
    for r in totals:
        sums[r["size"]][at[r["lang"]]] = r["n"]
    counts: list[dict[str, np.ndarray]] = [{}, {}]
    for n in range(LONGEST_GRAM + 1):
        for r in table.where(F.col("size") == n).select("gram", "by").toArrow().to_pylist():
            row = np.zeros(len(languages))
            for x in r["by"]:
                row[at[x["lang"]]] = x["n"]
            counts[n > 0][r["gram"]] = row
    scratch.drop(counted, best)
    return LanguageModel(languages, counts[0], counts[1], sums)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; other columns pass unseen. Null, empty and letterless texts are ``und`` with score 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    place = names.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                labels, scores = sent.value.predict(batch.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])
        pa.default_memory_pool().release_unused()  # the worker stays for other stages

    kept = docs.select(*names)
    return kept.mapInArrow(predict, StructType([*kept.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text, lang`` and others) with a language, by a model of all labelled rows.

    Only rows that are ``und`` go: those without a letter, null and empty ones among them, and all rows where there is no label to learn from.
    A score, however low, drops nothing. An empty table gives an empty one.
    """
    model = train(docs.select("doc_id", "text", "lang"))
    own = docs.select(*[F.col(c).alias(f"own_{c}") for c in docs.columns])  # so that no name clashes, and a text is sent once
    return identify(own, model, "own_text").where(F.col("lang_pred") != UNKNOWN).select(*[F.col(f"own_{c}").alias(c) for c in docs.columns])


def op9_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
