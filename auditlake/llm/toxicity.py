"""Toxicity as severity grades: cumulative-link ordinal regression on sparse word features.

P(grade >= k) = sigmoid(w.x - c_k) with one weight vector w for all cutpoints c_1 < c_2 < ... The
features are 1 + log(count) of the words and word beginnings that separate toxic from clean labelled
texts best; beginnings stand for the inflections of a word. The expected severity is the sum of
P(grade >= k) over k.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed

#: Labelled documents of each grade that are learned from, about; drawn by a hash of the id.
MAX_ROWS = 6000
MAX_FEATURES = 2048
#: A feature must be in so many labelled texts, and its log odds so many standard errors from zero.
MIN_TEXTS = 5
MIN_Z = 3.0
RIDGE = 0.3
STEPS = 300
REJECT = 0.5
PREFIXES = (4, 5)
_WORD = re.compile(r"\w+")


def features(text: str | None) -> Counter:
    """How often a text has each word and, marked by a star, each beginning of a longer word."""
    found = Counter(_WORD.findall((text or "").lower()))
    for word, n in list(found.items()):
        for size in PREFIXES:
            if len(word) > size:
                found[word[:size] + "*"] += n
    return found


class Model:
    """Words with their weights, and rising cutpoints; without cutpoints all is grade 0."""

    def __init__(self, weights: dict[str, float], cuts: list[float]):
        self.weights, self.cuts = weights, cuts

    def scores(self, text: str | None) -> tuple[float, int]:
        """Expected severity and the most probable grade (the lower one of equals)."""
        times = features(text)
        s = sum(self.weights[w] * (1 + np.log(times[w])) for w in sorted(self.weights.keys() & times.keys()))
        above = 1 / (1 + np.exp(np.clip(np.array(self.cuts) - s, -50, 50)))
        grades = np.concatenate([[1.0], above]) - np.concatenate([above, [0.0]])
        return float(above.sum()), int(grades.argmax())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def loss_and_gradient(w, cuts, rows, cols, values, grades, ridge: float):
    """Mean negative log-likelihood with a ridge on w (sparse triples rows, cols, values)."""
    n = len(grades)
    s = np.bincount(rows, values * w[cols], minlength=n)
    edges = np.concatenate([[-np.inf], cuts, [np.inf]])
    with np.errstate(invalid="ignore"):
        a, b = _sigmoid(s - edges[grades]), _sigmoid(s - edges[grades + 1])
    a[grades == 0], b[grades == len(cuts)] = 1.0, 0.0
    p = np.maximum(a - b, 1e-12)
    ds = -(1 - a - b)
    dcut = np.bincount(grades, a * (1 - a) / p, minlength=len(edges) - 1)
    dcut -= np.bincount(grades + 1, b * (1 - b) / p, minlength=len(edges) - 1)[:len(edges) - 1]
    dw = np.bincount(cols, values * ds[rows], minlength=len(w)) + ridge * w
    return (-np.log(p).sum() + 0.5 * ridge * (w @ w)) / n, dw / n, dcut[1:] / n


def fit_ordinal(rows, cols, values, grades, features: int, ridge: float = RIDGE, steps: int = STEPS):
    """Weights and cutpoints by Adam on all rows; cutpoints are a first one and positive gaps."""
    top = int(grades.max()) if len(grades) else 0
    if top == 0:
        return np.zeros(features), np.zeros(0)
    share = np.array([(grades >= k).mean() for k in range(1, top + 1)]).clip(1e-4, 1 - 1e-4)
    first = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(first), 1e-3))
    x = np.concatenate([np.zeros(features), first[:1], gaps])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        gap = np.exp(x[features + 1:])
        cuts = x[features] + np.concatenate([[0.0], np.cumsum(gap)])
        _, dw, dc = loss_and_gradient(x[:features], cuts, rows, cols, values, grades, ridge)
        after = np.cumsum(dc[::-1])[::-1]
        g = np.concatenate([dw, after[:1], after[1:] * gap])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = 0.2 * (1 - 0.7 * step / steps)
        x = x - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-10)
    gap = np.exp(x[features + 1:])
    return x[:features], x[features] + np.concatenate([[0.0], np.cumsum(gap)])


def _feature_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts that hold each feature, by whether they are toxic, of one partition."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, grade in zip(batch["text"], batch["grade"]):
            (toxic if grade > 0 else clean).update(features(text).keys())
    every = list(toxic.keys() | clean.keys())
    for at in range(0, len(every), 50_000):
        some = every[at:at + 50_000]
        yield pd.DataFrame({"word": some, "toxic": [toxic[w] for w in some], "clean": [clean[w] for w in some]})


def select_features(sample: DataFrame, most: int = MAX_FEATURES) -> list[tuple[str, float]]:
    """The features whose log odds between toxic and clean texts are farthest from zero, with these
    in standard errors."""
    sizes = sample.groupBy((F.col("grade") > 0).alias("toxic")).count().collect()
    n1 = sum(r["count"] for r in sizes if r.toxic)
    n0 = sum(r["count"] for r in sizes if not r.toxic)
    counts = (sample.select("text", "grade").mapInPandas(_feature_texts, "word string, toxic long, clean long")
              .groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
              .filter(F.col("t") + F.col("c") >= MIN_TEXTS))
    t, c, t0, c0 = (F.col("t") + 0.5), (F.col("c") + 0.5), (n1 - F.col("t") + 0.5), (n0 - F.col("c") + 0.5)
    z = (F.log(t / t0) - F.log(c / c0)) / F.sqrt(1 / t + 1 / t0 + 1 / c + 1 / c0)
    best = (counts.withColumn("z", z).filter(F.abs("z") >= MIN_Z)
            .orderBy(F.desc(F.abs("z")), "word").limit(most))
    return [(r.word, r.z) for r in best.select("word", "z").collect()]


def fit(docs: DataFrame, graded: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model of `docs` (doc_id, text) with `graded` (doc_id, grade).

    Where the grades are only 0 and 1, grade 1 is divided in two by `refined`. Of each grade, about `max_rows` ids are learned from; an id with several grades has the highest.
    Only the counts of these rows' selected words come to the driver.
    """
    one = (graded.filter("doc_id is not null and grade >= 0").groupBy("doc_id")
           .agg(F.max("grade").cast("int").alias("grade")))
    sizes = {r.grade: r.n for r in one.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not any(g > 0 for g in sizes):
        return Model({}, [])
    share = F.create_map(*[F.lit(x) for g, n in sizes.items() for x in (g, max_rows / n)])
    drawn = checkpointed(one.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
                                    < share[F.col("grade")]))
    # About `max_rows` ids of each grade: small by the parameter, whatever the table's size.
    sample = checkpointed(docs.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id"]).select("text", "grade"))
    chosen = select_features(sample)
    place = {w: i for i, (w, _) in enumerate(chosen)}

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            times = [{place[w]: n for w, n in features(t).items() if w in place} for t in batch["text"]]
            yield pd.DataFrame({"grade": batch["grade"], "cols": [list(t) for t in times],
                                "counts": [list(t.values()) for t in times]})

    data = sample.mapInPandas(sparse, "grade int, cols array<int>, counts array<int>").collect()
    # The same order whatever the partitions, so that the fit is the same.
    data = sorted((r.grade, sorted(zip(r.cols, r.counts))) for r in data)
    grades = np.array([g for g, _ in data], np.int64)
    rows = np.repeat(np.arange(len(data)), [len(x) for _, x in data])
    cols = np.array([c for _, x in data for c, _ in x], np.int64)
    values = 1 + np.log(np.array([n for _, x in data for _, n in x], float))
    if grades.max(initial=0) == 1:
        amounts = [sum(n for c, n in x if chosen[c][1] > 0) for _, x in data]
        grades, sizes = refined(grades, np.array(amounts), sizes)
    w, cuts = fit_ordinal(rows, cols, values, grades, len(chosen))
    # The draw levels the grades; the cutpoints must know their true shares.
    return Model({word: float(x) for (word, _), x in zip(chosen, w)}, _shifted(cuts, grades, sizes).tolist())


def refined(grades: np.ndarray, amounts: np.ndarray, sizes: dict[int, int]) -> tuple[np.ndarray, dict[int, int]]:
    """Grades 0, 1, 2 from 0, 1: grade 2 has more toxic features than the median of those with any."""
    some = amounts[(grades == 1) & (amounts > 0)]
    if not len(some):
        return grades, sizes
    out = np.where((grades == 1) & (amounts > np.median(some)), 2, grades)
    share = (out == 2).sum() / (grades == 1).sum()
    return out, sizes | {1: sizes[1] * (1 - share), 2: sizes[1] * share}


def _shifted(cuts: np.ndarray, grades: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Cutpoints moved from the sample's odds of P(grade >= k) to those of all labels."""
    total = sum(sizes.values())
    out = []
    for k, c in enumerate(cuts, 1):
        here = np.clip((grades >= k).mean(), 1e-9, 1 - 1e-9)
        true = np.clip(sum(n for g, n in sizes.items() if g >= k) / total, 1e-9, 1 - 1e-9)
        out.append(c + np.log(here / (1 - here)) - np.log(true / (1 - true)))
    return np.maximum.accumulate(np.array(out))


def severity_column(spark: SparkSession, text: Column, model: Model) -> Column:
    """A struct (severity, grade). A null or empty text has the severity of one without any feature."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, grade int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([shared.value.scores(t) for t in batch], columns=["severity", "grade"])
    return run(text.cast("string"))


def grades_of(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Grades from the labels table: 0 clean, 1 toxic. Unlabelled rows go."""
    return (labels.filter(F.col("toxic").isNotNull())
            .select(F.col(id_col).alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("grade")))


def severities(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               reject: float = REJECT) -> DataFrame:
    """(doc_id, severity, grade, rejected) of each row of `docs`; rejected from `reject` on."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = fit(named, grades_of(labels))
    return (named.select("doc_id", severity_column(docs.sparkSession, F.col("text"), model).alias("s")).select("doc_id", "s.*")
            .withColumn("rejected", F.col("severity") >= reject))
