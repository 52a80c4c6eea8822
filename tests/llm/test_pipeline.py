import collections
import random

import pytest

import corpus_pipeline
from auditlake.llm import packing, secrets, stages

from .helpers import docs
from .test_line_templates import slow_drop
from .test_simhash import slow_groups


def corpus(rng):
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 7))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choices(vocabulary, k=n))
    rows = []
    for i in range(120):
        lines = [text(rng.randrange(5, 30)) for _ in range(3)]
        if i % 3 == 0:
            lines.insert(1, "shared line of the site footer, all rights reserved")
        if i % 4 == 0:
            lines.append("vile horrid " + text(4))
        if i % 5 == 0:
            lines.append(f"login password = hunter2{i} for " + text(4))
        rows.append((i, "\n".join(lines)))
    rows += [(200 + i, rows[i][1]) for i in range(0, 60, 7)] + [(300, None), (301, ""), (302, "")]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = corpus(random.Random(6))
    path = str(tmp_path_factory.mktemp("corpus"))
    frame = docs(spark, [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], ", toxicity int, fp int")
    frame.write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int("vile" in t)) for i, t in rows if t]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_against_slow_versions(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, folder)
        assert out.columns == frame.columns and dict(out.dtypes) == dict(frame.dtypes)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        frame = spark.read.parquet(path)
        if name == "toxicity":
            rows = [r for r in rows if "vile" not in (r[1] or "")]
        elif name == "line_dedup":
            rows = slow_drop(rows)
        elif name == "near_duplicates":
            kept = {g for _, _, g in slow_groups(rows)}
            rows = [r for r in rows if r[0] in kept]
        else:
            rows = [(i, t if t is None else secrets.redact(t, secrets.find(t)[1])) for i, t in rows]
        got = frame.collect()
        assert sorted((r.doc_id, r.text) for r in got if r.text is not None) == sorted(r for r in rows if r[1] is not None)
        assert len(got) == len(rows) and all(r.text is None or r.n_chars == len(r.text) for r in got)
    assert not any("hunter2" in (t or "") for _, t in rows) and any("[assign]" in (t or "") for _, t in rows)
    name, stage = corpus_pipeline.STAGES[-1]
    got = stage(spark, frame, folder).collect()
    words = packing.WordEncoder()
    want = collections.Counter((i, len(ids) + 1) for (i, _), ids in zip(rows, words.ids([t for _, t in rows])))
    assert collections.Counter((r.doc_id, r.length) for r in got) == want
    whole = sorted((r.doc_id, r.length) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == sorted(want.elements())


def test_stages_take_an_empty_table(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, folder).count() == 0


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "secrets", "packing"]
    assert stages.STAGES is corpus_pipeline.STAGES
