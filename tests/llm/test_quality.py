import collections
import math
import random
import re
from fractions import Fraction

from pyspark.sql import functions as F

from auditlake.llm import quality

from .helpers import EDGE_TEXTS, docs, texts

SHOWN = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(windows)
    covered = {p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(covered))


def test_counts_against_brute_force(spark):
    rng = random.Random(5)
    values = EDGE_TEXTS + [" ".join(rng.choices("abc*", k=n)) + rng.choice(["", "\nx y\nx y\n \n \n"])
                           for n in range(60)]
    values += ["a b c d e " * 30000, "z" * 100000, "a\rb\x0bc\x85d a\rb"]
    got = {r.doc_id: tuple(r[c] for c in SHOWN) for r in quality.counted(texts(spark, values)).collect()}
    assert got == {i: slow_counts(v) for i, v in enumerate(values)}


def test_binomial_against_exact_sums(spark):
    cases = [(k, n, p) for p in (0.004, 0.1) for n in (1, 7, 20, 21, 60, 500, 4000)
             for k in {0, int(n * p / 2), int(n * p)}]
    for k, n, p in cases:
        exact = float(sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1)))
        c = quality.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)
        assert math.isclose(spark.range(1).select(c).first()[0], exact, rel_tol=1e-9), (k, n, p)


def slow_cutoffs(rows, rule_values, grid, alpha, delta, pairs):
    """rows of (stratum, good, value) of one rule: the cutoff in use by stratum."""
    out = {}
    for stratum in {s for s, _, _ in rows}:
        good = [v for s, g, v in rows if s == stratum and g]
        bad = [v for s, g, v in rows if s == stratum and not g]
        best = None
        for at, c in enumerate(grid):
            k, n = sum(v > c for v in good), len(good)
            tail = sum(math.comb(n, i) * alpha ** i * (1 - alpha) ** (n - i) for i in range(k + 1))
            gain = sum(v > c for v in bad) / max(1, len(bad)) - 2 * k / max(1, n)
            if n and tail <= delta / pairs and gain > 0 and (best is None or gain > best[0]):
                best = (gain, c)
        if best:
            out[stratum] = best[1]
    return out


def test_cutoffs_against_brute_force(spark):
    rng = random.Random(2)
    rows, n = [], 100
    for i in range(1500):
        good = rng.random() < 0.7
        symbols = int(rng.betavariate(1, 12 if good else 3) * 100)
        rows.append((i, "ab"[i % 5 == 0], good, n, n, symbols, 1, 0, 0))
    frame = spark.createDataFrame(rows, "doc_id long, stratum string, good boolean, n_words long, word_chars long, "
                                        "n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    grid = [0.9 * 0.9 ** i for i in range(30)]
    rules = {"symbols": (quality.RULES["symbols"][0], grid)}
    got = {r.stratum: r.cutoff for r in quality.cutoffs(frame, rules, 0.05, 0.1).collect()}
    want = slow_cutoffs([(s, g, v / n) for _, s, g, _, _, v, *_ in rows], None, grid, 0.05, 0.1, 2)
    assert want and got == want


def test_false_rejection_is_limited(spark):
    """Good and bad documents alike: nothing separates them, so hardly anything is lost."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["word", "other", "*", "thing"], k=40)), "en") for i in range(400)]
    labels = spark.createDataFrame([(i, int(rng.random() < 0.8)) for i in range(400)], "doc_id long, quality int")
    found = quality.quality_rules(docs(spark, rows), labels)
    assert found.filter("not kept and not base_failed").count() <= 0.05 * 400


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    clash = ", stratum string, n_words string, kept int"
    rows = [(1, "a b " * 20, None), (1, "a b " * 20, None), (None, None, "en"), (2, "", "en")]
    got = quality.quality_rules(docs(spark, rows, clash), labels).collect()
    assert len(got) == 4 and not any(r.kept for r in got)
    assert quality.quality_rules(docs(spark, []), labels.limit(0)).count() == 0


def test_many_strata_use_the_salted_join(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_BROADCAST_CUTOFFS", 0)
    rows = [(i, "*** " * 30 if i % 2 else "good words are here now " + " ".join(f"w{j}{i}" for j in range(20)), "en")
            for i in range(5000)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(5000)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "MAX_REPEAT_PERCENT", 101)
    found = quality.quality_rules(docs(spark, rows), labels)
    assert {(r.doc_id % 2, r.kept) for r in found.collect()} == {(0, True), (1, False)}
