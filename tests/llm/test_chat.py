import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from auditlake.llm import chat

F = chat.F
SCHEMA = "conv_id long, turn long, role string, text string, uid string, tree string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def by_tree(formatted):
    return {r.tree: r for r in chat.digests(formatted).collect()}


def expected(turns):
    """Digests of (role, text) in order."""
    turns = [(r or "", t or "") for r, t in turns]
    learned = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))


def of(row):
    return row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256


ODD = ["<|end|>\n<|turn|>assistant<|text|>", r"<\|end|>", r"<\\|\|<|", "<", "|>", r"\### Assistant: </turn> ok", "<<|", "\\",
       "", None, "é 漢字 🙂", "\n\n", "$1 \\1", "<|turn|>"]


def test_control_strings_come_back(spark):
    rows = [(i, k, role, text) for i, text in enumerate(ODD) for k, role in enumerate(["user", "assistant"])]
    rows += [(100 + i, 0, text, "x") for i, text in enumerate(ODD)]
    got = by_tree(chat.format_conversations(conversations(spark, rows)))
    for i, text in enumerate(ODD):
        assert of(got[i]) == expected([("user", text), ("assistant", text)])
        assert of(got[100 + i]) == expected([(text, "x")])


def test_escaping_leaves_no_control_string_and_other_text_alone(spark):
    out = chat.format_conversations(conversations(spark, [(1, 0, "user", "a <b> \\ c | d"), (1, 1, "assistant", "<|end|>")]))
    text = out.first().formatted
    assert text == "<|turn|>user<|text|>a <b> \\ c | d<|end|>\n<|turn|>assistant<|text|><\\|end|><|end|>\n"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<|\\ae>\n$", max_size=12), min_size=1, max_size=30))
def test_any_text_comes_back(spark, texts):
    rows = [(i, 0, "assistant", t) for i, t in enumerate(texts)]
    got = by_tree(chat.format_conversations(conversations(spark, rows)))
    for i, t in enumerate(texts):
        assert of(got[i]) == expected([("assistant", t)])


def test_long_conversations_in_parts(spark):
    """Parts of a path of any length come back in order; turns need not be dense."""
    turns = {7: [(k * 3, "assistant" if k % 2 else "user", f"text {k} <|") for k in range(9001)],
             8: [(k, "user", "x") for k in range(64)], 9: [(k, "assistant", "y") for k in range(65)]}
    rows = [(c, *t) for c, some in turns.items() for t in some]
    formatted = chat.format_conversations(conversations(spark, rows))
    sizes = {r["tree"]: r["n"] for r in formatted.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {7: 141, 8: 1, 9: 2}
    got = by_tree(formatted)
    for c, some in turns.items():
        assert of(got[c]) == expected([(r, t) for _, r, t in some])


def test_null_ids_turns_and_repeated_rows(spark):
    rows = [(None, 1, "assistant", "b"), (None, 0, "user", "a"), (5, None, "user", "last"), (5, 3, "assistant", "first"),
            (6, 0, "user", "same"), (6, 0, "user", "same"), (6, 0, None, None)]
    got = by_tree(chat.format_conversations(conversations(spark, rows)))
    assert of(got[None]) == expected([("user", "a"), ("assistant", "b")])
    assert of(got[5]) == expected([("assistant", "first"), ("user", "last")])
    assert of(got[6]) == expected([(None, None), ("user", "same"), ("user", "same")])


def test_empty_table(spark):
    assert chat.digests(chat.format_conversations(conversations(spark, []))).count() == 0


def messages(spark, rows):
    return spark.createDataFrame(rows, "tree string, node string, parent string, role string, text string, score double")


def slow_paths(rows):
    """Each root-to-leaf path of each tree as texts, best mean score first."""
    children, nodes = {}, {}
    for tree, node, parent, _, text, score in rows:
        nodes[tree, node] = (parent, text, score or 0.0)
    for (tree, node), (parent, *_) in nodes.items():
        children.setdefault((tree, parent if (tree, parent) in nodes else None), []).append(node)
    out = {}

    def go(tree, node, path):
        path = [*path, nodes[tree, node]]
        below = children.get((tree, node), []) if node is not None else []
        if not below:
            out.setdefault((tree, path[0][1]), []).append((-sum(s for *_, s in path) / len(path), [t for _, t, _ in path]))
        for b in below:
            go(tree, b, path)

    for (tree, parent), some in children.items():
        if parent is None:
            for node in some:
                go(tree, node, [])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("most", [None, 2])
def test_trees_against_a_walk(spark, most):
    import random
    rng = random.Random(4)
    rows = []
    for tree in ("a", "b", None):
        for i in range(60):
            parent = None if i == 0 else f"n{rng.randrange(max(0, i - 7), i)}"
            rows.append((tree, f"n{i}", parent, "user", f"{tree}{i}", rng.random()))
    rows += [("c", "x", "gone", "user", "orphan", None), ("c", "y", "z", "user", "round", 1.0), ("c", "z", "y", "user", "round", 1.0),
             ("c", "w", "z", "user", "behind", 1.0), ("c", None, "x", "user", "no name", 0.5)]
    formatted = chat.format_trees(messages(spark, rows).repartition(4), score_col="score", most=most, part=4)
    got = {}
    for r in formatted.select("tree", "leaf", "branch", "part", chat.read_turns(F.col("formatted")).alias("t")).collect():
        got.setdefault((r.tree, r.leaf, r.branch), []).append((r.part, [t.text for t in r.t]))
    paths = {}
    for (tree, _, branch), parts in got.items():
        texts = [t for _, some in sorted(parts) for t in some]
        paths.setdefault((tree, texts[0]), {})[branch] = texts
    want = slow_paths([r for r in rows if r[0] != "c"]) | {("c", "orphan"): [(0, ["orphan", "no name"])]}
    assert paths == {k: {i + 1: t for i, (_, t) in enumerate(v[:most])} for k, v in want.items()}
    loss = formatted.select(F.size("loss").alias("n")).agg(F.sum("n")).first()[0]
    assert loss == 0
