"""Chat formatting over reply trees.

Messages form trees: each names the message it answers. Every node first gets a pointer to its parent;
self-joins then double all pointers (parent, grandparent, four up, ...) until each reaches its root, which
gives every node its root, its depth and the sum of scores on its path in as many joins as the depth has
binary digits. Leaves are ranked within their root by the mean score of their path. Only for the chosen
leaves are paths enumerated, by joining with the same pointers: a leaf with the nodes less than 2**k above
it has, after one more join, those less than 2**(k+1) above it. All of this moves ids only.

The text is joined to the paths at the end, and each path is formatted as one conversation, in parts of
`PART` turns, so that no row holds a conversation of any length. A turn is

    <|turn|>role<|text|>words of the turn<|end|>

and a line break. Inside roles and texts each `<`, any backslashes, `|` gets one backslash more before
the bar: no control string is left in them, all other text stays as it is, and taking one backslash away
gives back the original. Loss spans cover the texts of assistant turns.
"""

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import running_number
from .common import checkpointed, shared_folder

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
LEARNED = "assistant"
#: Turns in one part of a formatted conversation.
PART = 64
#: Turn numbers in one slice when the rows of a conversation are numbered.
SLICE = 4096


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1\|")


# Trees

def _named(rows: DataFrame, **columns: Column) -> DataFrame:
    """The columns asked for, with a number `uid` for each row, written down once."""
    path = shared_folder(rows.sparkSession, "messages")
    numbered = rows.select(*[c.alias(n) for n, c in columns.items()]).withColumn("uid", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    return rows.sparkSession.read.schema(numbered.schema).parquet(path)


def reply_links(messages: DataFrame) -> DataFrame:
    """(uid, up, score): the row that each of `messages` (tree, node, parent, uid, ...) answers.

    A parent that is null or not there makes a root. Where several rows have one node id, replies
    hang below the first by a hash of role and text.
    """
    first = F.min(F.struct(F.xxhash64("role", "text").alias("hash"), "uid"))
    nodes = (messages.filter(F.col("node").isNotNull()).groupBy("tree", "node").agg(first.alias("first"))
             .select("tree", F.col("node").alias("parent"), F.col("first.uid").alias("up")))
    return messages.select("tree", "parent", "uid", "score").join(nodes, ["tree", "parent"], "left").select("uid", "up", "score")


def turn_links(rows: DataFrame) -> DataFrame:
    """(uid, up, score) for `rows` (tree, turn, role, text, uid): each turn answers the one before it.

    Null turns come last; turns of one number are in order of role and a hash of the text.
    """
    last = F.lit(2 ** 62)
    placed = rows.select("tree", "uid", F.coalesce("turn", last).alias("turn"), "role", F.xxhash64("text").alias("hash"))
    sliced = placed.withColumn("slice", F.floor(F.col("turn") / SLICE))
    numbered = checkpointed(running_number(sliced, ["tree"], ["slice"], ["turn", "role", "hash", "uid"])
                            .select("tree", "uid", F.col("_number").alias("at")))
    before = numbered.select("tree", (F.col("at") + 1).alias("at"), F.col("uid").alias("up"))
    return numbered.join(before, ["tree", "at"], "left").select("uid", "up", F.lit(0.0).alias("score"))


def climb(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(uid, root, depth, total) of each node, and the pointers (uid, up) to 1, 2, 4, ... nodes above.

    Nodes in a circle, and those that hang below one, have no root and are left out.
    """
    now = checkpointed(links.select("uid", "up", F.coalesce("up", "uid").alias("root"),
                                    F.col("up").isNotNull().cast("long").alias("depth"),
                                    F.coalesce("score", F.lit(0.0)).alias("total")))
    pointers, before = [], None
    while True:
        going = now.filter(F.col("up").isNotNull())
        n = going.count()
        # Any node at depth 2**k or more has ancestors at all lower depths: none less means circles only.
        if not n or n == before:
            break
        before = n
        pointers.append(going.select("uid", "up"))
        other = now.select(F.col("uid").alias("up"), F.col("up").alias("_up"), F.col("root").alias("_root"),
                           F.col("depth").alias("_depth"), F.col("total").alias("_total"))
        moved = going.join(other, "up").select("uid", F.col("_up").alias("up"), F.col("_root").alias("root"),
                                               (F.col("depth") + F.col("_depth")).alias("depth"),
                                               (F.col("total") + F.col("_total")).alias("total"))
        now = checkpointed(now.filter(F.col("up").isNull()).unionByName(moved))
    return now.filter(F.col("up").isNull()).drop("up"), pointers


def branches(links: DataFrame, most: int | None = None) -> DataFrame:
    """(leaf, branch, uid, position, last) of each node on each chosen path from a root to a leaf.

    `branch` counts the leaves of a root from 1, highest mean score first, ties by leaf; only the first
    `most` of each root are chosen, all where it is None. `position` counts from 0 at the root, `last`
    is that of the leaf.
    """
    nodes, pointers = climb(links)
    leaves = nodes.join(links.select(F.col("up").alias("uid")).distinct(), "uid", "left_anti").withColumn(
        "mean", -F.col("total") / (F.col("depth") + 1))
    if most is None:
        # All leaves of a root may be most of the table: they are numbered in slices.
        sliced = checkpointed(leaves.repartitionByRange("root", "mean", "uid").withColumn("slot", F.spark_partition_id()))
        ranked = running_number(sliced, ["root"], ["slot"], ["mean", "uid"]).withColumnRenamed("_number", "branch")
    else:
        order = Window.partitionBy("root").orderBy("mean", "uid")
        ranked = leaves.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= most)
    paths = checkpointed(ranked.select(F.col("uid").alias("leaf"), F.col("branch").cast("long"), "uid",
                                       F.col("depth").alias("position"), F.col("depth").alias("last")))
    for k, up in enumerate(pointers):
        above = paths.join(up, "uid").select("leaf", "branch", F.col("up").alias("uid"),
                                             (F.col("position") - 2 ** k).alias("position"), "last")
        paths = checkpointed(paths.unionByName(above))
    return paths


# Formatting

def _format(messages: DataFrame, links: DataFrame, most: int | None, part: int) -> DataFrame:
    paths = branches(links, most)
    # `parts` is a key, so that a filter on it reaches the paths before any text is joined.
    paths = paths.withColumns({"part": F.floor(F.col("position") / part), "parts": F.floor(F.col("last") / part) + 1})
    turns = paths.join(messages.select("uid", "tree", "role", "text"), "uid")
    one = F.struct("position", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy("leaf", "branch", "part", "parts").agg(
        F.sort_array(F.collect_list(one)).alias("turns"), F.first("tree").alias("tree"))
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(TURN), escaped(t.role), F.lit(TEXT)).alias("head"), escaped(t.text).alias("body"),
        (t.role == LEARNED).alias("learned")))
    no_spans = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def with_span(done: Column, p: Column) -> Column:
        start = done["at"] + F.length(p.head)
        end = start + F.length(p.body)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(p.learned, F.concat(done["spans"], span))
                        .otherwise(done["spans"]).alias("spans"))

    spans = F.aggregate("pieces", F.struct(F.lit(0).cast("long").alias("at"), no_spans.alias("spans")), with_span)
    joined = F.concat_ws("", F.transform("pieces", lambda p: F.concat(p.head, p.body, F.lit(END))))
    return (grouped.withColumn("pieces", pieces)
            .select(F.col("tree._1").alias("tree"), "leaf", "branch", "part", "parts", joined.alias("formatted"),
                    spans["spans"].alias("loss")))


def _tree(name: str) -> Column:
    """The tree as a struct, which is never null itself, so that rows without a name are a tree too."""
    return F.struct(F.col(name).alias("_1"))


def format_trees(messages: DataFrame, tree_col: str = "tree", node_col: str = "node", parent_col: str = "parent",
                 role_col: str = "role", text_col: str = "text", score_col: str | None = None,
                 most: int | None = None, part: int = PART) -> DataFrame:
    """(tree, leaf, branch, part, parts, formatted, loss): each chosen path as one conversation.

    `leaf` is a number of the path's last message, `loss` the spans (start, end) of `formatted`, in
    characters, that are learned. A path of more than `part` turns lies in several rows. Null roles and
    texts count as empty, null scores as zero; repeated rows are messages of their own (see
    `reply_links`); a message whose parent is not there is a root; messages in a circle are on no path.
    Other columns are not looked at. An empty table gives no rows.
    """
    score = F.lit(0.0) if score_col is None else F.col(score_col).cast("double")
    rows = _named(messages, tree=_tree(tree_col), node=F.col(node_col), parent=F.col(parent_col),
                  role=F.col(role_col).cast("string"), text=F.col(text_col).cast("string"), score=score)
    return _format(rows, reply_links(rows), most, part)


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", part: int = PART) -> DataFrame:
    """As `format_trees` for conversations given by turns: each is a tree of one branch."""
    named = _named(rows, tree=_tree(conv_col), turn=F.col(turn_col).cast("long"),
                   role=F.col(role_col).cast("string"), text=F.col(text_col).cast("string"))
    return _format(named, turn_links(named), None, part)


# Reading back

def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of formatted text."""
    turns = F.split(formatted, r"<\|turn\|>")
    turns = F.slice(turns, F.lit(2), F.size(turns))

    def turn(t: Column) -> Column:
        sides = F.split(t, r"<\|text\|>", 2)
        body = F.element_at(sides, 2)
        return F.struct(unescaped(F.element_at(sides, 1)).alias("role"),
                        unescaped(F.substring(body, F.lit(1), F.length(body) - len(END))).alias("text"))

    return F.transform(turns, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss spans."""
    return F.transform(loss, lambda s: unescaped(
        F.substring(formatted, (s.start + 1).cast("int"), (s.end - s.start).cast("int"))))


_DIGESTS = "tree {kind}, leaf long, branch long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of paths whose parts follow each other, with one part in memory at a time."""
    leaf, row, hashes = None, None, []

    def done() -> pd.DataFrame:
        return pd.DataFrame([{**row, "turns_sha256": hashes[0].hexdigest(), "loss_sha256": hashes[1].hexdigest()}])

    for batch in batches:
        for r in batch.to_dict("records"):
            if r["leaf"] != leaf:
                if row is not None:
                    yield done()
                leaf, hashes = r["leaf"], [hashlib.sha256(), hashlib.sha256()]
                row = {k: r[k] for k in ("tree", "leaf", "branch")} | {"n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
            for h, part in zip(hashes, (r["turns"], r["learned"])):
                h.update(part.encode())
            for k in ("n_turns", "loss_chars", "formatted_chars"):
                row[k] += r[k]
    if row is not None:
        yield done()


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from each formatted conversation, as counts and hashes.

    The text of a conversation in one part is hashed where it lies; only longer ones are brought
    together, and hashed part by part in order.
    """
    kind = formatted.schema["tree"].dataType.simpleString()
    back = formatted.withColumns({"back": read_turns(F.col("formatted")),
                                  "under": read_loss(F.col("formatted"), F.col("loss"))})
    read = back.select(
        "tree", "leaf", "branch", "part", "parts", F.size("back").cast("long").alias("n_turns"),
        F.concat_ws("", F.transform("back", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))).alias("turns"),
        F.concat_ws("", "under").alias("learned"), F.length("formatted").cast("long").alias("formatted_chars")
    ).withColumn("loss_chars", F.length("learned").cast("long"))
    columns = ["tree", "leaf", "branch", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    short = read.filter(F.col("parts") == 1).withColumns({
        "turns_sha256": F.sha2("turns", 256), "loss_sha256": F.sha2("learned", 256)}).select(*columns)
    long = (read.filter(F.col("parts") > 1).repartition("leaf").sortWithinPartitions("leaf", "part")
            .mapInPandas(_in_order, _DIGESTS.format(kind=kind)).select(*columns))
    return short.unionByName(long)
