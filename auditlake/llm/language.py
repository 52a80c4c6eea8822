"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, and what is no letter counts as a space. The n-grams of order one to three
are hashed to a power of two of buckets. The log-probability matrix (buckets by languages) is
broadcast; its size is the number of buckets, which shrink as languages grow, times the languages.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS = (1, 2, 3)
BITS = 15
MAX_MATRIX = 256 << 20
#: Rows of a language that are learned from, about; chosen by a hash of their content.
MAX_ROWS = 20_000
SMOOTHING = 0.5
#: Characters counted or scored at once.
TOGETHER = 400_000
_MULTIPLIER = np.uint32(0x9E3779B1)
_letters = None


def letter_table() -> np.ndarray:
    """Whether a code point is a letter, made once for each worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")


def ngram_buckets(texts: list[str], bits: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Where each text starts, the bucket of the n-gram at each character for each order, and
    whether each text has a letter. N-grams that run into the next text have the bucket 2**bits."""
    codes = [_points(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in codes])])
    flat = np.full(int(starts[-1]) + max(ORDERS), 32, np.uint32)
    for at, c in zip(starts.tolist(), codes):
        flat[at:at + len(c)] = c
    is_letter = letter_table()[flat]
    flat[~is_letter] = 32
    n = int(starts[-1])
    ends = np.repeat(starts[1:] - 1, np.diff(starts))
    out, mixed = [], np.zeros(n, np.uint32)
    for order in range(1, max(ORDERS) + 1):
        mixed = (mixed * np.uint32(0x01000193) + flat[order - 1:order - 1 + n] + np.uint32(order)) * _MULTIPLIER
        if order in ORDERS:
            bucket = (mixed >> np.uint32(32 - bits)).astype(np.int32)
            bucket[np.arange(n) + order > ends + 1] = 1 << bits
            out.append(bucket)
    has = np.add.reduceat(is_letter[:n], starts[:-1]) > 0
    return starts[:-1], out, has


def _chunks(texts: list[str], size: int) -> Iterator[list[int]]:
    """Numbers of texts, together about `size` characters; a longer text stands alone."""
    some, used = [], 0
    for i, t in enumerate(texts):
        if some and used + len(t) > size:
            yield some
            some, used = [], 0
        some.append(i)
        used += len(t)
    if some:
        yield some


class Model:
    """Languages in order, and the log-probability of each bucket; the last bucket counts nothing."""

    def __init__(self, languages: list[str], counts: np.ndarray, rows: np.ndarray):
        self.languages = languages
        self.bits = counts.shape[1].bit_length() - 1
        smooth = counts + SMOOTHING
        logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T
        self.matrix = np.vstack([logs, np.zeros(len(languages))])
        self.prior = np.log((rows + 1) / (rows + 1).sum())

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its posterior probability; ties go to the first language."""
        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return langs, scores
        for some in _chunks(texts, TOGETHER // (1 + len(self.languages) // 8)):
            starts, orders, has = ngram_buckets([texts[i] for i in some], self.bits)
            total = np.tile(self.prior, (len(some), 1))
            for buckets in orders:
                total += np.add.reduceat(self.matrix[buckets], starts, axis=0)
            best = total.argmax(axis=1)
            share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            for i, b, s, letters in zip(some, best.tolist(), share.tolist(), has.tolist()):
                if letters:
                    langs[i], scores[i] = self.languages[b], s
        return langs, scores


def _counted(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                texts = texts.tolist()
                for some in _chunks(texts, TOGETHER):
                    _, orders, _ = ngram_buckets([texts[i] for i in some], bits)
                    for buckets in orders:
                        found = np.bincount(buckets, minlength=(1 << bits) + 1)[:-1]
                        totals[lang] = totals.get(lang, 0) + found
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": counts[at]})
    return run


def fit(rows: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model of rows (text, lang); rows with a null in either, or an empty text, teach nothing.

    The counts are made on the executors; languages times buckets of them come to the driver.
    """
    rows = rows.filter("text is not null and lang is not null and text <> ''")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 2)), np.zeros(0))
    bits = min(BITS, (MAX_MATRIX // (8 * len(languages))).bit_length() - 1)
    draw = F.pmod(F.xxhash64("text", "lang"), F.lit(1_000_003)) / 1_000_003.0
    if max(sizes.values()) > max_rows:
        share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, max_rows / n)])
        rows = rows.filter(draw < share[F.col("lang")])
    found = (rows.select("lang", "text").mapInPandas(_counted(bits), "lang string, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((len(languages), 1 << bits))
    place = {k: i for i, k in enumerate(languages)}
    counts[found["lang"].map(place).to_numpy(np.int64), found["bucket"].to_numpy()] = found["n"].to_numpy()
    return Model(languages, counts, np.array([sizes[k] for k in languages], float))


def predict_column(spark: SparkSession, text: Column, model: Model) -> Column:
    """A struct (lang, score); `und` and 0 for a null text and one without letters."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, scores = shared.value.predict([t or "" for t in batch])
            yield pd.DataFrame({"lang": langs, "score": scores})
    return run(text.cast("string"))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row; learned from the rows not held out."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
    model = fit(named.filter(~held_out(F.col("doc_id"))), max_rows)
    return (named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         predict_column(docs.sparkSession, F.col("text"), model).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score"))
