"""Line dedup with a log-template tree.

A line's place in the tree is fixed by its number of tokens and its first `DEPTH` tokens, with
tokens that hold a digit taken as variable. Within such a leaf, a token that `min_docs` documents hold
at its position can be constant, any other is a variable field. A line has a row of shapes: all that can
be constant, then without the tokens that are held least (by documents, each counted once for every
different line it has), and so on while at least `min_constant` of its tokens are left. A shape in
`min_docs` documents or more recurs, and the largest of a line's shapes that does is its template, so a
field with frequent values does not hide it. Lines of a template are dropped from all documents but the
first.

Whatever else is in its leaf, a line recurs by itself if `min_docs` documents hold it verbatim (two
are enough for a line of `long_bytes`), or with other numbers while more than half of its tokens
(`MIN_WORDS`) hold no digit. Lines under `min_tokens` tokens but of `min_bytes` or more, as in scripts
without spaces, take part verbatim.

Everything is counted over all lines by narrow rows of hashes. Lines are looked at token by token only
in leaves that can recur with variable fields, and for that one document of each is cut once more.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.losers import loser_bitmaps, without_losers
from .common import checkpointed, new_name

DEPTH = 3
MIN_CONSTANT = 0.7


class Rule(NamedTuple):
    """Which lines take part and what recurs."""
    min_docs: int = 3
    min_constant: float = MIN_CONSTANT
    min_tokens: int = 3
    min_bytes: int = 16
    #: From so many bytes on, two documents are enough for a line that is the same in both.
    long_bytes: int = 256


#: More than this part of a line that is alike but for its numbers must be words.
MIN_WORDS = 0.5
VARIABLE = "<*>"
#: Above so many lines (of 24 bytes each), candidates are joined by a shuffle.
MAX_BROADCAST_LINES = 500_000
_LINE = ["leaf", "line"]


def _masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), VARIABLE).otherwise(t))


def _rows(docs: DataFrame, id_col: str, text_col: str, rule: Rule) -> DataFrame:
    """(doc_id, text_hash, no, verbatim, numbered, bytes, tokens) of each line that takes part.

    `verbatim` are the tokens as they are. White space is made alike in the whole text first, since
    cutting at one character takes far less time than at a pattern; so does asking the text for digits.
    """
    text = F.col(text_col).cast("string")
    named = docs.select(F.col(id_col).alias("doc_id"), F.translate(text, "\t\x0b\x0c\r", "    ").alias("text"),
                        F.xxhash64(text).alias("text_hash"), text.rlike("[0-9]").alias("digits"))
    split = named.select("doc_id", "text_hash", "digits", F.posexplode(F.split("text", "\n")).alias("no", "text"))
    trimmed = F.btrim("text")
    numbered = F.when(F.col("digits"), F.col("text").rlike("[0-9]")).otherwise(False)
    return (split.select("doc_id", "text_hash", "no", F.array_remove(F.split(trimmed, " "), "").alias("verbatim"),
                         F.octet_length(trimmed).alias("bytes"), numbered.alias("numbered"))
            .filter((F.size("verbatim") >= rule.min_tokens) | (F.col("bytes") >= rule.min_bytes))
            .withColumn("tokens", F.when(F.col("numbered"), _masked(F.col("verbatim"))).otherwise(F.col("verbatim"))))


def _keyed(rows: DataFrame, rule: Rule) -> DataFrame:
    """The rows with `leaf` and `line`, and verbatim in leaves of their own the short lines and, once
    more, those with numbers.

    A line in `least` documents recurs by itself; null: only by a template.
    """
    words = F.size(F.filter("tokens", lambda t: t != VARIABLE))
    exact = F.when(F.col("bytes") >= rule.long_bytes, min(2, rule.min_docs)).otherwise(rule.min_docs)
    least = F.when(~F.col("numbered"), exact).when(words > MIN_WORDS * F.size("tokens"), rule.min_docs)
    masked = F.struct(F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)).alias("leaf"),
                      F.xxhash64("tokens").alias("line"), least.alias("least"))
    own = F.xxhash64("verbatim")
    verbatim = F.struct(own.alias("leaf"), own.alias("line"), exact.alias("least"))
    entries = (F.when(F.size("verbatim") < rule.min_tokens, F.array(verbatim))
               .when(F.col("numbered"), F.array(masked, verbatim)).otherwise(F.array(masked)))
    return rows.select("*", F.inline(entries))


def _small(df: DataFrame) -> DataFrame:
    """`df` for a join by broadcast if its rows are few, which is counted."""
    return F.broadcast(df) if df.limit(MAX_BROADCAST_LINES + 1).count() <= MAX_BROADCAST_LINES else df


def _held(rows: DataFrame, key: list[str], few: DataFrame, min_docs: int) -> DataFrame:
    """(key, held) of the keys of `rows` (leaf, line, key, docs) in at least `min_docs` documents.

    A key is surely there if one of its lines is in as many. Else documents are counted, since one may
    hold several of the lines: from `few`, the documents (doc_id, leaf, line) of lines that are in fewer.
    """
    summed = checkpointed(rows.groupBy(*key).agg(F.sum("docs").alias("held"), F.max("docs").alias("most"))
                          .filter(F.col("held") >= min_docs))
    unsure = summed.filter(F.col("most") < min_docs).select(*key)
    lines = rows.join(unsure, key, "left_semi").select(*dict.fromkeys([*_LINE, *key]))
    counted = (few.join(lines, _LINE).select("doc_id", *key).distinct()
               .groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).drop("n"))
    sure = summed.filter(F.col("most") >= min_docs).drop("most")
    return sure.unionByName(summed.drop("most").join(counted, key, "left_semi"))


def recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """All lines (doc_id, text_hash, no, leaf, line), and the recurring ones (leaf, line, first_id).

    `first_id` is the smallest id of a document with the template; null ids count as one document
    and come after all others.
    """
    min_docs = rule.min_docs
    keyed = _keyed(_rows(docs, id_col, text_col, rule), rule)
    lines = checkpointed(keyed.select("doc_id", "text_hash", "no", *_LINE, "least"))
    distinct = checkpointed(
        lines.groupBy("doc_id", *_LINE).agg(F.min("least").alias("least")).groupBy(*_LINE)
        .agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_id"), F.min("least").alias("least")))
    leaves = (distinct.groupBy("leaf").agg(F.sum("docs").alias("leaf_docs"), F.count(F.lit(1)).alias("leaf_lines"))
              .filter((F.col("leaf_docs") >= min_docs) & (F.col("leaf_lines") > 1)).select("leaf"))
    shared = checkpointed(distinct.join(leaves, "leaf", "left_semi"))
    by_itself = F.coalesce(F.col("docs") >= F.col("least"), F.lit(False))
    alone = distinct.filter(by_itself).select(*_LINE, "first_id")
    rare = _small(shared.filter(F.col("docs") < min_docs).select(*_LINE))
    few = checkpointed(lines.join(rare, _LINE, "left_semi").select("doc_id", *_LINE).distinct())

    # The tokens of a line are taken from its first document; documents without such a line are not cut again.
    wanted = shared.select(*_LINE, F.col("first_id").alias("doc_id"))
    ids = wanted.select(F.col("doc_id").alias("_wanted")).distinct()
    some = docs
    if ids.limit(MAX_BROADCAST_LINES + 1).count() <= MAX_BROADCAST_LINES:
        named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        some = named.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("_wanted")), "left_semi")
        id_col, text_col = "doc_id", "text"
    cut = _keyed(_rows(some, id_col, text_col, rule), rule)
    one = [F.col(f"k.{c}") == F.col(f"w.{c}") for c in _LINE] + [F.col("k.doc_id").eqNullSafe(F.col("w.doc_id"))]
    seen = cut.alias("k").join(_small(wanted).alias("w"), one, "left_semi").dropDuplicates(_LINE).select(*_LINE, "tokens")
    tokens = checkpointed(seen.join(shared, _LINE).select(
        *_LINE, "docs", "first_id", by_itself.alias("alone"), F.size("tokens").alias("n"), F.posexplode("tokens").alias("at", "token"))
        .withColumn("token", F.xxhash64("token")))
    constant = tokens.filter(F.col("token") != F.xxhash64(F.lit(VARIABLE)))
    fixed = tokens.join(_held(constant, ["leaf", "at", "token"], few, min_docs), ["leaf", "at", "token"])
    # The tokens of a line that are held as much, or more. Their order does not matter: their
    # number and two mixed sums stand for them.
    above = Window.partitionBy(*_LINE).orderBy(F.col("held").desc())
    shapes = fixed.select(
        *_LINE, "docs", "first_id", "alone", "n", F.count(F.lit(1)).over(above).alias("fixed"),
        F.bit_xor(F.xxhash64("at", "token")).over(above).alias("mix"),
        F.bit_xor(F.xxhash64("token", "at")).over(above).alias("mix2"))
    key = ["leaf", "fixed", "mix", "mix2"]
    shapes = checkpointed(shapes.filter(F.col("fixed") >= rule.min_constant * F.col("n")).dropDuplicates([*_LINE, "fixed"]))
    found = _held(shapes, key, few, min_docs).drop("held")
    own = (shapes.filter(~F.col("alone")).join(found, key, "left_semi").groupBy(*_LINE)
           .agg(F.max(F.struct("fixed", "mix", "mix2")).alias("own"), F.first("first_id").alias("first_id")))
    own = checkpointed(own)
    templates = own.groupBy("leaf", "own").agg(F.min("first_id").alias("first_id"))
    general = own.drop("first_id").join(templates, ["leaf", "own"]).select(*_LINE, "first_id")
    return lines, checkpointed(alone.unionByName(general))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None,
               rule: Rule = Rule()) -> DataFrame:
    """`docs` without its recurring lines, all columns kept; `count_col` gets the number dropped.

    A null text stays null, lines that take no part always stay, and a document can be left with an
    empty text. Rows with the same id are one document. Lines that only null ids share stay. Texts of
    any length are read whole. An empty table stays empty.
    """
    lines, found = recurring(docs, id_col, text_col, rule)
    later = lines.drop("least").join(_small(found), _LINE).filter(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    gone = loser_bitmaps(later.select("doc_id", "text_hash", F.col("no").alias("ordinal")), ("doc_id", "text_hash"))
    # Names that `docs` does not have.
    doc, hashed, bits, mine = (new_name(docs, n) for n in ("id_of_gone", "hash_of_gone", "gone", "text_hash"))
    gone = gone.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed), F.col("losers").alias(bits))
    text = F.col(text_col).cast("string")
    same = F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(mine) == F.col(hashed))
    joined = docs.withColumn(mine, F.xxhash64(text)).join(gone, same, "left")
    kept = without_losers(F.split(text, "\n"), F.col(bits))
    cleaned = joined.withColumn(text_col, F.when(F.col(bits).isNull(), text).otherwise(F.array_join(kept, "\n")))
    if count_col:
        ones = F.aggregate(bits, F.lit(0), lambda n, part: n + F.aggregate(part, F.lit(0), lambda m, w: m + F.bit_count(w)))
        cleaned = cleaned.withColumn(count_col, F.coalesce(ones, F.lit(0)))
    return cleaned.select(*docs.columns, *([count_col] if count_col else []))
