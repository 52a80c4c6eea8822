import collections
import random
import re

from auditlake.llm import line_templates as lt

from .helpers import EDGE_TEXTS, docs, texts


def tokens_of(line):
    return [t for t in re.split(r"[\x20\x09-\x0D]+", line) if t]


def masked(line):
    return tuple("<*>" if re.search("[0-9]", t) else t for t in tokens_of(line))


def slow_drop(rows, min_docs=3, min_constant=0.7, min_tokens=3, min_bytes=16, long_bytes=256):
    """The cleaned texts of rows (id, text) by the rules as told, with all lines in memory; no null ids."""
    documents, exact, least = collections.defaultdict(set), {}, {}
    for i, text in rows:
        for line in (text or "").split("\n") if text is not None else []:
            own, size = tuple(tokens_of(line)), len(line.strip(" \t\n\x0b\x0c\r").encode())
            if len(own) < min_tokens and size < min_bytes:
                continue
            same = min(2, min_docs) if size >= long_bytes else min_docs
            documents["verbatim", own].add(i)
            exact[own] = min(same, exact.get(own, same))
            if len(own) >= min_tokens:
                documents["masked", masked(line)].add(i)
                words = sum(t != "<*>" for t in masked(line))
                if masked(line) == own:
                    least[own] = min(same, least.get(own, same))
                elif words > 0.5 * len(own):
                    least[masked(line)] = min(min_docs, least.get(masked(line), min_docs))
    first = {}
    leaves = collections.defaultdict(list)
    for (kind, tokens), ids in documents.items():
        if kind == "verbatim" and len(ids) >= exact[tokens]:
            first[kind, tokens] = min(ids)
        if kind == "masked":
            leaves[len(tokens), tokens[:3]].append(tokens)
            if len(ids) >= least.get(tokens, 10 ** 9):
                first[kind, tokens] = min(ids)
    for members in leaves.values():
        if len(members) < 2:
            continue
        holders, held = collections.defaultdict(set), collections.Counter()
        for tokens in members:
            for at, t in enumerate(tokens):
                holders[at, t] |= documents["masked", tokens]
                held[at, t] += len(documents["masked", tokens])
        shapes, having = {}, collections.defaultdict(set)
        for tokens in members:
            can = [(at, t) for at, t in enumerate(tokens) if t != "<*>" and len(holders[at, t]) >= min_docs]
            for level in {held[x] for x in can}:
                shape = frozenset(x for x in can if held[x] >= level)
                if len(shape) >= min_constant * len(tokens):
                    shapes.setdefault(tokens, []).append(shape)
                    having[shape] |= documents["masked", tokens]
        own = {}
        for tokens, mine in shapes.items():
            good = [s for s in mine if len(having[s]) >= min_docs]
            if good and ("masked", tokens) not in first:
                own.setdefault(max(good, key=len), []).append(tokens)
        for alike in own.values():
            for t in alike:
                first["masked", t] = min(min(documents["masked", x]) for x in alike)
    def stays(i, line):
        own, size = tuple(tokens_of(line)), len(line.strip(" \t\n\x0b\x0c\r").encode())
        if len(own) < min_tokens and size < min_bytes:
            return True
        keys = [("masked", masked(line))] * (len(own) >= min_tokens) + [("verbatim", own)] * (len(own) < min_tokens or masked(line) != own)
        return all(first.get(k, i) == i for k in keys)

    return [(i, text if text is None else "\n".join(x for x in text.split("\n") if stays(i, x))) for i, text in rows]


def run(frame, **options):
    return sorted(((r.doc_id, r.text) for r in lt.drop_lines(frame, **options).collect()), key=str)


def made(rng):
    vocabulary = "the of a report user login from host page next all rights kept".split()
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.randrange(1, 8)):
            kind = rng.randrange(5)
            if kind == 0:
                lines.append(f"user {rng.choice(vocabulary)}{rng.randrange(9)} login from host {rng.randrange(99)}")
            elif kind == 1:
                lines.append("printed by the office of " + rng.choice(["Ann", "Bob", "Cy", "Di", f"q{'x' * i}"]) + " in May")
            elif kind == 2:
                lines.append("all rights reserved")
            elif kind == 3:
                lines.append(" ".join(rng.choices(vocabulary, k=rng.randrange(1, 7))))
            else:
                lines.append(" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(8)))
        rows.append((i, "\n".join(lines)))
    return rows


def test_against_a_slow_version(spark, monkeypatch):
    rows = made(random.Random(1)) + [(200 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(300, None)]
    want = sorted(slow_drop(rows), key=str)
    assert any(a != b for a, b in zip(sorted(rows, key=str), want))
    assert run(docs(spark, rows)) == want
    monkeypatch.setattr(lt, "MAX_BROADCAST_LINES", -1)
    assert run(docs(spark, rows)) == want


def test_other_rules_against_the_slow_version(spark):
    rows = made(random.Random(2)) + [(400 + i, "two words\na long line that two hold " + "x" * (i % 2)) for i in range(6)]
    rule = lt.Rule(min_docs=4, min_constant=0.5, min_tokens=2, min_bytes=9, long_bytes=20)
    assert run(docs(spark, rows), rule=rule) == sorted(slow_drop(rows, *rule), key=str)


def test_documents_are_counted_and_not_lines(spark):
    """Three lines of one template in two documents are not three documents."""
    line = "This story was filed by {} under sports"
    rows = [(1, line.format("Ann") + "\n" + line.format("Bob")), (2, line.format("Cid"))]
    assert run(docs(spark, rows)) == rows
    rows += [(3, line.format("Dee"))]
    assert run(docs(spark, rows)) == [rows[0], (2, ""), (3, "")]
    assert sorted(slow_drop(rows)) == [rows[0], (2, ""), (3, "")]


def test_variable_fields_share_a_template(spark):
    rows = [(i, f"Sent to you by {n} from the main office today\n{n} {n}x went {n}y away")
            for i, n in enumerate(["Ann", "Bob", "Cyd", "Dan"])]
    got = dict(run(docs(spark, rows)))
    assert got[0] == rows[0][1]
    assert [got[i] for i in (1, 2, 3)] == [f"{n} {n}x went {n}y away" for n in ("Bob", "Cyd", "Dan")]


def test_two_documents_are_not_enough_and_long_passages_go(spark):
    passage = " ".join(f"word{'abcdefghij'[i % 10]}{'xyz'[i % 3]}" for i in range(60))
    rows = [(1, "twice seen line here"), (2, "twice seen line here")]
    rows += [(i, f"{passage}\nunique {chr(97 + i)} line {'q' * i}") for i in range(3, 9)]
    got = dict(run(docs(spark, rows)))
    assert got[1] == got[2] == "twice seen line here" and passage in got[3]
    assert all(passage not in got[i] and "unique" in got[i] for i in range(4, 9))


def test_edges(spark):
    rows = [(None, "a shared line here"), (None, "a shared line here"), (4, "a shared line here\nrest"),
            (5, "a shared line here"), (5, "a shared line here"), (5, "other\na shared line here"), (6, None), (7, "")]
    frame = docs(spark, rows, ", gone int, text_hash string, Leaf int, id_of_gone long, hash_of_gone long, __id long, __hash long")
    got = lt.drop_lines(frame, count_col="n_dropped")
    assert got.columns == [*frame.columns, "n_dropped"]
    assert sorted(((r.doc_id, r.text, r.n_dropped) for r in got.collect()), key=str) == sorted(
        [(None, "", 1), (None, "", 1), (4, "a shared line here\nrest", 0), (5, "", 1), (5, "", 1), (5, "other", 1),
         (6, None, 0), (7, "", 0)], key=str)
    assert lt.drop_lines(docs(spark, [])).count() == 0
    assert run(texts(spark, ["one " * 200000])) == [(0, "one " * 200000)]


def test_fields_with_frequent_values_do_not_hide_a_template(spark):
    authors, sections = [f"a{'x' * i}" for i in range(6)], [f"s{'y' * i}" for i in range(5)]
    pairs = [(a, s) for a in authors for s in sections]
    rows = [(i, f"This story was filed by {a} under {s}") for i, (a, s) in enumerate(pairs)]
    rows += [(100 + i, f"Printed for you by the office of {n}") for i, n in enumerate(["Ann"] * 20 + ["Bob"] * 2)]
    got = dict(run(docs(spark, rows)))
    # Sections are held by more documents than authors, so a template is a section's.
    assert [i for i in range(30) if got[i]] == [0, 1, 2, 3, 4]
    assert [i for i in range(100, 122) if got[i]] == [100, 120]


def test_numbers_do_not_depend_on_the_neighbours(spark):
    rows = [(i, f"Call 555 123 4567 today now\n{7 + i} 8 9\n2019 2020 {i} in") for i in range(4)]
    rows += [(9, "Call 555 999 1111 anytime folks"), (10, "2019 2020 3 on"), (11, "2019 2020 3 at")]
    got = dict(run(docs(spark, rows)))
    assert got[0] == rows[0][1]
    assert [got[i] for i in (1, 2, 3)] == [f"{7 + i} 8 9\n2019 2020 {i} in" for i in (1, 2, 3)]
    assert all(got[i] == t for i, t in rows[4:])
    # Without the neighbour, and verbatim without any word.
    rows = [(i, "Call 555 123 4567 today now\n1 2 3") for i in range(4)]
    assert dict(run(docs(spark, rows))) == {0: rows[0][1], 1: "", 2: "", 3: ""}


def test_lines_without_spaces_and_long_lines_in_two_documents(spark):
    unspaced, long = "本网站所有内容版权归原作者所有", " ".join(f"long{'abcdefghij'[i % 10] * i}" for i in range(55))
    rows = [(i, f"{unspaced}\nRead more") for i in range(3)] + [(i, f"{long}\n{long} 77") for i in (5, 6)]
    rows += [(7, "短い行"), (8, "短い行"), (9, "短い行")]
    got = dict(run(docs(spark, rows)))
    assert got[0] == rows[0][1] and got[1] == got[2] == "Read more"
    assert got[5] == rows[3][1] and got[6] == "" and got[7] == got[8] == got[9] == "短い行"
