"""Quality rules with risk-controlled cutoffs, in built-in functions only.

Each rule rejects a document when its value is above a cutoff. For each stratum and rule the
cutoffs of a fixed grid are tested from the loosest to the tightest on labelled good documents: a
cutoff holds if P(Binomial(n, alpha) <= false rejections) is at most delta divided by the number of
(stratum, rule) pairs (Bonferroni; within a pair the tests are a fixed sequence, which needs no
more). With alpha split over the rules, the share of good documents that a stratum loses is at most
`ALPHA`, in all strata at once, with probability 1 - `DELTA`. Of the cutoffs that hold, the one
that separates bad from good labels best is used, if any separates them at all.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, checkpointed

ALPHA = 0.02
DELTA = 0.05
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Above so many cutoffs, the join with them is salted instead of broadcast.
MAX_BROADCAST_CUTOFFS = 100_000
SALTS = 64

_SHARES = [round(0.8 * 0.8 ** i, 5) for i in range(28)]
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("try_divide(n_symbols, word_chars)", _SHARES),
    "dup_lines": ("try_divide(n_dup_lines, n_lines)", _SHARES),
    "repeats": ("try_divide(n_repeat_words, n_words)", _SHARES),
    "long_words": ("try_divide(word_chars, n_words)", [40 * 0.9 ** i for i in range(24)]),
    "short_words": ("try_divide(n_words, word_chars)", [1.0 * 0.92 ** i for i in range(24)]),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """`body` of `value`, which is computed once for each row however often it is used."""
    return F.transform(F.array(value), body)[0]


def _removed(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside windows that occur twice or more in `words`."""
    def window(i):
        return [F.get(words, i + k) for k in range(WINDOW)]

    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def exact(ordered):
        def same(i, j):
            return F.coalesce(F.get(ordered, i)["key"] == F.get(ordered, j)["key"], F.lit(False))
        marked = F.transform(ordered, lambda x, i: F.when(same(i, i - 1) | same(i, i + 1), x["at"]))
        return _let(F.sort_array(F.filter(marked, lambda p: p.isNotNull())), covered)

    def covered(at):
        reach = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda s, x: s + x)

    # Equal windows have equal hashes: no hash twice means no window twice. The rest compare text.
    hashes = F.transform(starts, lambda i: F.xxhash64(*window(i)))
    keyed = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("key"), i.alias("at")))
    some = _let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return (F.when(F.size(words) <= WINDOW, F.lit(0).cast("long"))
            .when(~some, F.lit(0).cast("long")).otherwise(_let(F.sort_array(keyed), exact)))


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, counts) of each row. A null text counts as empty, a null stratum as ''."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
        text.alias("text"), F.filter(F.split(text, WORD_SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    whole = F.length("text")
    return split.select(
        "doc_id", "stratum", F.size("words").cast("long").alias("n_words"),
        _removed(F.col("text"), " \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (whole - _removed(F.col("text"), "#*$%&|<>")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _log_factorial(n: Column) -> Column:
    """ln n! of a whole number: exact up to 20, then Stirling's series (error below 1e-12)."""
    x = F.greatest(n.cast("double"), F.lit(1.0))
    series = (x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x)
              + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5))
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) for k <= n * p, where the terms fall from k downwards.

    Terms more than 40 standard deviations below k are under the precision of a double.
    """
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
                + k * math.log(p) + (n - k) * math.log1p(-p))
    last = F.greatest(F.lit(0).cast("long"), k - (1000 + 40 * F.sqrt(n.cast("double"))).cast("long"))
    steps = F.when(k > 0, F.sequence(k, F.least(k, last + 1), F.lit(-1).cast("long"))).otherwise(
        F.array().cast("array<long>"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(s, i):
        term = s["term"] * i / (n - i + 1) * ((1 - p) / p)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))
    return top * F.aggregate(steps, start, add)["total"]


def cutoffs(labelled: DataFrame, rules=None, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, good, false_rejections, bad, rejections) of the cutoffs in use.

    `labelled` has a row per labelled document: stratum, counts, and `good` (boolean; null rows are
    not used). The documents that fail the base rules take no part: no cutoff decides about them.
    """
    rules = RULES if rules is None else rules
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.coalesce(F.expr(v), F.lit(0.0)).alias("value"),
                              F.array(*map(F.lit, g)).alias("grid")) for r, (v, g) in rules.items()])
    rows = labelled.filter(F.col("good").isNotNull() & ~base_failed())
    tested = (rows.select("stratum", "good", F.explode(grid).alias("x"))
              .select("stratum", "good", "x.rule", F.posexplode("x.grid"), "x.value")
              .groupBy("stratum", "rule", "pos", F.col("col").alias("cutoff"))
              .agg(F.count_if(F.col("good")).alias("good"), F.count_if(~F.col("good")).alias("bad"),
                   F.count_if(F.col("good") & (F.col("value") > F.col("col"))).alias("false_rejections"),
                   F.count_if(~F.col("good") & (F.col("value") > F.col("col"))).alias("rejections")))
    tested = checkpointed(tested)
    pairs = max(1, tested.select("stratum", "rule").distinct().count())
    share = alpha / len(rules)
    k, n = F.col("false_rejections"), F.col("good")
    holds = (n > 0) & (k <= n * share)
    tail = F.when(holds, binomial_cdf(k, n, share)).otherwise(1.0)
    gain = (F.col("rejections") / F.greatest(F.col("bad"), F.lit(1))
            - 2 * k / F.greatest(n, F.lit(1)))
    # Tighter cutoffs reject no less: those that hold are all before the first that fails.
    best = F.max(F.struct(gain.alias("gain"), (-F.col("pos")).alias("at"), "cutoff", "good", "false_rejections",
                          "bad", "rejections")).alias("best")
    return (tested.filter((tail <= delta / pairs) & (gain > 0)).groupBy("stratum", "rule").agg(best)
            .select("stratum", "rule", "best.cutoff", "best.good", "best.false_rejections", "best.bad",
                    "best.rejections"))


def judged(counts: DataFrame, chosen: DataFrame, rules=None) -> DataFrame:
    """`counts` with base_failed, failed_rules (names) and kept."""
    rules = RULES if rules is None else rules
    by_stratum = checkpointed(chosen.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")))
    size = by_stratum.count()
    if size * len(rules) <= MAX_BROADCAST_CUTOFFS:
        joined = counts.join(F.broadcast(by_stratum), "stratum", "left")
    else:
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
        salted = by_stratum.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = counts.withColumn("salt", salt).join(salted, ["stratum", "salt"], "left").drop("salt")
    failed = F.array_compact(F.array(*[
        F.when(F.coalesce(F.expr(v), F.lit(0.0)) > F.try_element_at("cutoffs", F.lit(r)), F.lit(r)) for r, (v, _) in rules.items()]))
    return (joined.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("cutoffs"))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """One row per row of `docs`: doc_id, stratum, counts, base_failed, failed_rules, kept.

    Labels: 1 good, 0 bad, null unknown; an id with several labels is bad if one of them is. An id
    that occurs in several rows is tested once. Without labels only the base rules decide.
    """
    counts = checkpointed(counted(docs, id_col, text_col, stratum_col))
    good = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).dropna()
            .groupBy("doc_id").agg((F.min("label") > 0).alias("good")))
    labelled = counts.join(good, "doc_id").dropDuplicates(["doc_id"])
    return judged(counts, cutoffs(labelled))
