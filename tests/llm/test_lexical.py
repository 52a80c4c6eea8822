import math
import random
import re

import numpy as np

from auditlake.llm import lexical

from .helpers import EDGE_TEXTS, docs, texts

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def slow(documents, items, top=20):
    """[(item, rank, doc_id, score)] by scoring all; documents are (doc_id, text)."""
    cut = [(i, words(t)) for i, t in documents]
    n_docs, length = sum(bool(w) for _, w in cut), sum(len(w) for _, w in cut)
    df = {}
    for _, w in cut:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for doc_id, w in cut:
            score = 0
            for t in words(text):
                tf = w.count(t)
                if tf:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * ((10 ** 9 * tf) // (1000 * tf + 12 * (75 + 25 * len(w) * n_docs // length)))
            if score:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in frame.collect()), key=str)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def corpus(seed, n, vocabulary=60, longest=40):
    rng = random.Random(seed)
    vocab = [f"w{int(rng.expovariate(0.08))}" for _ in range(vocabulary)] + ["É", "naïve", "漢字"]
    return [" ".join(rng.choices(vocab, k=rng.randrange(1, longest))) for _ in range(n)]


def test_against_all_scores(spark):
    some = corpus(1, 400) + ["W1 w2! W1"] * 40
    asked = list(enumerate(corpus(2, 12)))
    found = lexical.lexical_search(texts(spark, some), items(spark, asked), top=7)
    assert result(found) == slow(list(enumerate(some)), asked, 7)


def test_shards_skip_blocks_and_lose_nothing(monkeypatch):
    """Blocks of three documents: the best of a shard are those of all scores, and blocks stay closed."""
    monkeypatch.setattr(lexical, "BLOCK", 3)
    monkeypatch.setattr(lexical, "OPENED", 2)
    rng = np.random.default_rng(3)
    weights = np.sort(rng.integers(0, 900, 40))[::-1].copy()
    matrix = rng.integers(1, 1000, (600, 40)) * (rng.random((600, 40)) < np.linspace(0.02, 0.7, 40))
    rows, cols = np.nonzero(matrix)
    asked = [np.sort(rng.choice(40, 9, replace=False)) for _ in range(30)]
    later = {}
    for terms in asked:
        for i, t in enumerate(terms.tolist()):
            later.setdefault(t, set()).update(terms[i:].tolist())
    later = {t: np.array(sorted(x)) for t, x in later.items()}
    scored = []

    class Counting(lexical.Found):
        def add(self, rows, scores):
            scored.append(len(rows))
            super().add(rows, scores)

    shard = lexical.Shard(600, rows, cols, matrix[rows, cols], weights, later, rng.normal(size=(40, 16)).astype(np.float32))
    ids = rng.permutation(600)
    for terms in asked:
        found = Counting(5).of(ids, np.zeros(600, bool))
        shard.search(terms, weights[terms], found)
        all_scores = matrix[:, terms] @ weights[terms]
        want = sorted((-s, i) for s, i in zip(all_scores.tolist(), ids.tolist()) if s > 0)[:5]
        assert list(zip((-found.scores).tolist(), found.ids.tolist())) == want
    assert sum(scored) < 0.6 * 600 * len(asked)
    for term, (listed, starts, known, summary) in shard.lists.items():
        assert sorted(listed.tolist()) == np.flatnonzero(matrix[:, term]).tolist()
        assert (np.diff(starts) > 0).all() and (np.diff(starts) <= 6).all()
        for b in range(len(starts) - 1):
            assert (summary[b] == matrix[listed[starts[b]:starts[b + 1]]][:, known].max(axis=0)).all()


def test_ties_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(i, "same text here") for i in (9, 3, None, 3, 7)] + [(1, None), (2, "")]
    frame = docs(spark, rows, ", item_id long, score long, term string")
    asked = [(5, "same here"), (5, "same here"), (None, "text"), (6, None), (7, "absent")]
    assert result(lexical.lexical_search(frame, items(spark, asked))) == slow(rows, asked)


def test_edge_and_long_texts(spark, monkeypatch):
    long = "start " + "filler words " * 200_000 + "x" * 3_000_000 + " END"
    some = [*EDGE_TEXTS, long, "start end"]
    asked = [(0, "one é x 漢字"), (1, "Start end filler"), (2, "x" * 3_000_000)]
    got = result(lexical.lexical_search(texts(spark, some), items(spark, asked)))
    assert got == slow(list(enumerate(some)), asked)


def test_items_in_several_blocks(spark):
    some, asked = corpus(5, 120), list(enumerate(corpus(6, 9)))
    got = lexical.lexical_search(texts(spark, some), items(spark, asked), max_terms=20)
    assert result(got) == slow(list(enumerate(some)), asked)


def test_empty_tables(spark):
    assert lexical.lexical_search(texts(spark, []), items(spark, [(1, "a")])).count() == 0
    assert lexical.lexical_search(texts(spark, ["a"]), items(spark, [])).count() == 0


def test_windows_cut_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "WINDOW", 5)
    text = "Ab, cdefghijk l--m é漢字 0z 　x"
    assert [w.decode() for some in lexical.terms_of(text) for w in some] == words(text)
