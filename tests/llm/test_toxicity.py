import numpy as np

from auditlake.llm import toxicity

from .helpers import EDGE_TEXTS, docs


def problem(seed=1, n=300, features=12, top=3):
    rng = np.random.default_rng(seed)
    x = (rng.random((n, features)) < 0.3) * rng.integers(1, 4, (n, features)).astype(float)
    true = np.linspace(-2, 2, features)
    s = x @ true + rng.logistic(size=n)
    grades = np.digitize(s, [0.5, 2.0, 3.5][:top])
    rows, cols = np.nonzero(x)
    return x, rows, cols, x[rows, cols], grades


def test_gradient_against_differences():
    _, rows, cols, values, grades = problem()
    rng = np.random.default_rng(2)
    w, cuts = rng.normal(size=12), np.array([-0.5, 0.3, 1.9])
    _, dw, dc = toxicity.loss_and_gradient(w, cuts, rows, cols, values, grades, 0.3)
    for target, grad in ((w, dw), (cuts, dc)):
        for i in range(len(target)):
            old = target[i]
            ends = []
            for h in (1e-6, -1e-6):
                target[i] = old + h
                ends.append(toxicity.loss_and_gradient(w, cuts, rows, cols, values, grades, 0.3)[0])
            target[i] = old
            assert abs((ends[0] - ends[1]) / 2e-6 - grad[i]) < 1e-6


def test_fit_reaches_a_minimum_with_rising_cuts():
    _, rows, cols, values, grades = problem()
    w, cuts = toxicity.fit_ordinal(rows, cols, values, grades, 12, steps=1500)
    _, dw, dc = toxicity.loss_and_gradient(w, cuts, rows, cols, values, grades, toxicity.RIDGE)
    assert np.abs(np.concatenate([dw, dc])).max() < 2e-3
    assert (np.diff(cuts) > 0).all() and np.corrcoef(w, np.linspace(-2, 2, 12))[0, 1] > 0.9


def test_expected_severity_is_the_mean_grade():
    model = toxicity.Model({"bad": 1.5, "wors*": 2.0}, [1.0, 2.5])
    s = 1.5 * (1 + np.log(2)) + 2.0
    above = 1 / (1 + np.exp(np.array([1.0, 2.5]) - s))
    mean, grade = model.scores("Bad, worst thing. BAD")
    probabilities = [1 - above[0], above[0] - above[1], above[1]]
    assert abs(mean - sum(k * p for k, p in enumerate(probabilities))) < 1e-12
    assert grade == int(np.argmax(probabilities))


def test_held_out_documents(spark):
    """Learned from half the labels: the other half's toxic documents are found, clean ones are left."""
    folder = "/root/testdata/sf0.1"
    frame, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.severities(frame, labels.filter("doc_id % 2 = 0")).join(labels, "doc_id").filter("doc_id % 2 = 1")
    counts = {(r.toxic, r.rejected): r["count"] for r in got.groupBy("toxic", "rejected").count().collect()}
    assert counts.get((0, True), 0) <= 0.01 * counts[0, False]
    assert counts[1, True] >= 0.9 * (counts[1, True] + counts.get((1, False), 0))


def test_edges(spark):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(None, "some words"), (3, "one"), (3, "one"),
                                                         (20, "vile " * 100000)]
    rows += [(100 + i, "vile words" if i % 2 else "kind words") for i in range(60)]
    labels = spark.createDataFrame([(100 + i, 1, i % 2) for i in range(60)] + [(None, 1, 1), (0, 1, None), (1, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.severities(docs(spark, rows, ", grade string, severity int, s int"), labels).collect()
    assert len(got) == len(rows)
    assert all(r.rejected for r in got if r.doc_id == 20)
    assert all(r.rejected == (r.doc_id % 2 == 1) for r in got if (r.doc_id or 0) >= 100)
    assert len({r.severity for r in got if r.doc_id in (0, 1, 2)}) == 1
    none = toxicity.severities(docs(spark, rows), labels.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.rejected for r in none)
    assert toxicity.severities(docs(spark, []), labels).count() == 0
