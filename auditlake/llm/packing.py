"""Best-fit packing of tokenised documents into sequences, by a grouping genetic algorithm.

Only (length, id) rows are packed; tokens never move. Pieces of full length are sequences of their
own. The others are dealt into blocks of about `BLOCK` pieces, and each block is a bin-packing
problem with several islands: populations of packings that start from best fit over different
orders. A child takes whole well-filled bins of one parent, then those bins of the other whose
pieces are all unused, and best-fits the displaced pieces, largest first. After each epoch every
island sends its elite to the next one. A block that reaches the lower bound (its tokens over the
capacity, rounded up) stops there, since no packing has fewer sequences. In the end the bins filled
worst of all blocks are dealt into blocks once more, so that blocks lose little against one whole.
"""

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, tokenizer_path

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK = 20_000
ISLANDS = 2
EPOCHS = 3
GENERATIONS = 4
POPULATION = 4
#: A worker's memory of words (the binary digits of its slots, of which half are used) and of their parts;
#: it starts anew when full, which costs time only.
SLOT_BITS, CACHE_PARTS = 21, 100_000
#: Texts are looked up together up to so many characters.
TOGETHER = 200_000
#: Longer words are not remembered: sums over so many characters could be alike by design.
LONGEST = 255
#: The bases of two word hashes: odd, so that they have inverses among 64-bit numbers.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Latin-1 letters fold to lower case one by one, and compose with nothing.
ODD = re.compile("[^\\t\\n\\r -~\xa1-\xff]")


# Tokens

def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class WordHashes:
    """Hashes of 64 and 32 bits of words in a byte array: sums of bytes times powers of a base, shifted back to
    where the word begins. One pass of sums serves all words."""

    def __init__(self):
        self.n, self.tables = 0, []

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(data) > self.n:
            self.n = len(data)
            self.tables = [(_powers(b, self.n), _powers(pow(b, -1, 1 << 64), self.n)) for b in BASES]
        out = []
        wide = data.astype(np.uint64) + np.uint64(1)
        for powers, inverse in self.tables:
            sums = np.cumsum(wide * powers[:len(data)])
            # A text begins with a space, so there is a sum before each word.
            h = (sums[ends - 1] - sums[starts - 1]) * inverse[starts]
            out.append(h ^ (h >> np.uint64(29)) * np.uint64(BASES[1]))
        return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


class WordTable:
    """Numbers of words by their hashes, in open slots; many are looked up at a time."""

    def __init__(self, bits: int):
        self.bits = bits
        self.one, self.two = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint32)
        self.clear()

    def clear(self) -> None:
        self.number, self.used = np.full(1 << self.bits, -1, np.int32), 0

    def _slots(self, one: np.ndarray) -> np.ndarray:
        return (one >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if it is not there."""
        out, at, slot = np.full(len(one), -1, np.int64), np.arange(len(one)), self._slots(one)
        while len(at):
            number = self.number[slot]
            same = (self.one[slot] == one[at]) & (self.two[slot] == two[at]) & (number >= 0)
            out[at[same]] = number[same]
            on = ~same & (number >= 0)
            at, slot = at[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, one: np.ndarray, two: np.ndarray, number: np.ndarray) -> None:
        """Words that are not there, each once."""
        at, slot = np.arange(len(one)), self._slots(one)
        self.used += len(one)
        while len(at):
            free = np.flatnonzero(self.number[slot] < 0)
            # Of several words for one slot the first takes it.
            _, first = np.unique(slot[free], return_index=True)
            mine = free[first]
            self.one[slot[mine]], self.two[slot[mine]], self.number[slot[mine]] = one[at[mine]], two[at[mine]], number[at[mine]]
            on = np.ones(len(at), bool)
            on[mine] = False
            at, slot = at[on], slot[on]
            taken = self.number[slot] >= 0
            slot = np.where(taken, (slot + 1) & ((1 << self.bits) - 1), slot)


class WordEncoder:
    """Ids of texts, looked up by white-space separated words.

    The tokenizer's own splitting ends a token at any white space and its normalisation does not
    reach across one, so the ids of a text are those of its words in order, and those of a word are
    those of its parts. Words of Latin-1 texts are found many at a time, by two hashes of 96 bits together.
    Those not met before are cut into parts, which are learned as one text: the tokenizer's normalisation
    has nothing left to do then, nor has its pattern, and both are left out. Each part ends in an
    end-of-word token, which tells where the ids of the next one begin.
    """

    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    SPACES = bytes.maketrans(b"\t\n\r", b"   ")

    def __init__(self, name: str = TOKENIZER):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.plain = Tokenizer.from_file(tokenizer_path(name))
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.is_end = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.is_end[ends] = True
        # Ids of a part as bytes, four for an id; the ids of word k lie from starts[k] to starts[k + 1].
        self.parts: dict[str, bytes] = {}
        self.hashes, self.table = WordHashes(), WordTable(SLOT_BITS)
        self._clear()

    def _clear(self) -> None:
        self.table.clear()
        self.words, self.starts, self.flat = 0, np.zeros(1 << 16, np.int64), np.zeros(1 << 18, "<u4")

    def _learn_parts(self, parts: list[str]) -> None:
        ids = np.array(self.plain.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.is_end[ids]) + 1
        if len(stops) != len(parts):
            raise ValueError("the tokenizer does not split as expected")
        data, stops = ids.tobytes(), (4 * stops).tolist()
        self.parts.update(zip(parts, map(data.__getitem__, map(slice, [0, *stops], stops))))

    def _learn(self, words: list[str]) -> np.ndarray:
        """Numbers for words that have none."""
        split = list(map(self.PARTS.findall, words))
        distinct = set().union(*split)
        new = [p for p in distinct if p not in self.parts]
        if len(self.parts) + len(new) > CACHE_PARTS:
            self.parts.clear()
            new = list(distinct)
        if new:
            self._learn_parts(new)
        find = self.parts.__getitem__
        coded = [find(p[0]) if len(p) == 1 else b"".join(map(find, p)) for p in split]
        ids = np.frombuffer(b"".join(coded), "<u4")
        n, used = self.words, int(self.starts[self.words])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(words) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[used:used + len(ids)] = ids
        self.starts[n + 1:n + 1 + len(words)] = used + np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) // 4)
        self.words += len(words)
        return np.arange(n, n + len(words))

    def _numbers(self, text: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word of a text."""
        one, two = self.hashes(data, starts, ends)
        found = self.table.find(one, two)
        long = ends - starts > LONGEST
        found[long] = -1
        new = np.flatnonzero(found < 0)
        if not len(new):
            return found
        order = new[np.lexsort((two[new], one[new], long[new]))]
        # Equal words, but for long ones, are learned once.
        first = np.ones(len(order), bool)
        first[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]]) | long[order[1:]]
        heads = order[first]
        if self.table.used + len(heads) > 1 << (SLOT_BITS - 1):
            self._clear()
            return self._numbers(text, data, starts, ends)
        words = [text[a:b].decode("latin-1") for a, b in zip(starts[heads].tolist(), ends[heads].tolist())]
        numbers = self._learn(words)
        found[order] = numbers[np.cumsum(first) - 1]
        keep = ~long[heads]
        self.table.add(one[heads[keep]], two[heads[keep]], numbers[keep])
        return found

    def _direct(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of texts that are Latin-1 and hold no special token."""
        folded = [t.lower().encode("latin-1") for t in texts]
        text = b" " + b" ".join(folded).translate(self.SPACES) + b" "
        data = np.frombuffer(text, np.uint8)
        space = data == 32
        turns = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = turns[::2], turns[1::2]
        k = self._numbers(text, data, starts, ends) if len(starts) else starts
        first = self.starts[k]
        lengths = self.starts[k + 1] - first
        stops = np.cumsum(lengths)
        flat = self.flat[np.repeat(first - stops + lengths, lengths) + np.arange(stops[-1] if len(stops) else 0)].tobytes()
        # The words of a text begin before the space behind it.
        behind = np.cumsum([len(f) + 1 for f in folded])
        bounds = (4 * np.append(0, stops)[np.searchsorted(starts, behind)]).tolist()
        for a, b in zip([0, *bounds], bounds):
            yield flat[a:b]

    def encoded(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian bytes, four for an id; a null text has none."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            plain = "<|" not in text and not ODD.search(text)
            if plain:
                waiting.append(text)
                size += len(text)
            if waiting and (not plain or size > TOGETHER):
                yield from self._together(waiting)
                waiting, size = [], 0
            if not plain:
                yield self._direct(text).tobytes()
        if waiting:
            yield from self._together(waiting)

    def ids(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; a null one has none."""
        for data in self.encoded(texts):
            yield np.frombuffer(data, "<u4")


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(name: str = TOKENIZER) -> WordEncoder:
    """One for each worker process, so that later tasks find the words of earlier ones."""
    if name not in _ENCODERS:
        _ENCODERS[name] = WordEncoder(name)
    return _ENCODERS[name]


def pieces_column(text: Column, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> Column:
    """An array of (piece, start, length, ids_crc32) of a document with its end id."""
    step, end = 4 * capacity, END_ID.to_bytes(4, "little")

    @F.pandas_udf("struct<tokens:long,crcs:array<long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = encoder(tokenizer)
        for batch in batches:
            tokens, crcs = [], []
            for data in words.encoded(batch):
                data += end
                tokens.append(len(data) // 4)
                crcs.append([zlib.crc32(data[at:at + step]) for at in range(0, len(data), step)])
            yield pd.DataFrame({"tokens": tokens, "crcs": crcs})

    found = run(text.cast("string"))
    # One value in an array, so that the texts are encoded once for all pieces.
    return F.flatten(F.transform(F.array(found), lambda f: F.transform(f["crcs"], lambda crc, i: F.struct(
        i.alias("piece"), (i.cast("long") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), f["tokens"] - i.cast("long") * capacity).alias("length"), crc.alias("ids_crc32")))))


def tokens_column(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """A document's ids with its end id, for writing sequences."""
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = encoder(tokenizer)
        for batch in batches:
            yield pd.Series([np.append(ids, np.uint32(END_ID)).astype(np.int32) for ids in words.ids(list(batch))])
    return run(text.cast("string"))


# The genetic algorithm; a packing is a list of bins, a bin a list of item numbers

Bins = list[list[int]]


def best_fit(items: list[int], sizes: list[int], capacity: int, bins: Bins | None = None) -> Bins:
    """Puts `items`, in their order, each into the fullest bin that has room."""
    bins = [] if bins is None else bins
    room = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in items:
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            free, k = room.pop(at)
            bins[k].append(i)
        else:
            free, k = capacity, len(bins)
            bins.append([i])
        if free > sizes[i]:
            insort(room, (free - sizes[i], k))
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unequal fill: full bins beside empty ones."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def crossover(one: Bins, two: Bins, sizes: list[int], capacity: int, rng) -> Bins:
    """Whole well-filled bins of `one`, the untouched bins of `two`, and best fit for the rest."""
    filled = sorted(one, key=lambda b: -sum(sizes[i] for i in b))
    share = max(1, int(len(filled) * rng.uniform(0.3, 0.9)))
    child = [list(b) for b in filled[:share]]
    used = {i for b in child for i in b}
    displaced = []
    for b in two:
        if used.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in used]
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, capacity, child)


def mutate(bins: Bins, sizes: list[int], capacity: int, rng) -> Bins:
    """Empties some of the worst-filled bins and best-fits their pieces anew."""
    order = sorted(bins, key=lambda b: sum(sizes[i] for i in b))
    n = min(len(order), max(2, int(len(order) * rng.uniform(0.01, 0.1))))
    loose = sorted((i for b in order[:n] for i in b), key=lambda i: -sizes[i])
    return best_fit(loose, sizes, capacity, [list(b) for b in order[n:]])


def lower_bound(sizes: list[int], capacity: int) -> int:
    return max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))


def evolve(sizes: list[int], capacity: int, population: list[Bins], seed: int,
           generations: int = GENERATIONS) -> list[Bins]:
    """The population after some generations, best first; at once if it holds an optimum."""
    rng = np.random.default_rng(seed)
    bound = lower_bound(sizes, capacity)
    everyone = sorted(population, key=lambda p: fitness(p, sizes, capacity), reverse=True)
    for _ in range(generations):
        if len(everyone[0]) <= bound:
            break
        a, b = everyone[int(rng.integers(0, max(1, len(everyone) // 2)))], everyone[int(rng.integers(0, len(everyone)))]
        child = mutate(crossover(a, b, sizes, capacity, rng), sizes, capacity, rng)
        everyone.append(child)
        everyone.sort(key=lambda p: fitness(p, sizes, capacity), reverse=True)
        everyone = everyone[:POPULATION]
    return everyone


def first_population(sizes: list[int], capacity: int, seed: int) -> list[Bins]:
    """Best fit over the falling order, and, if that is no optimum, over disturbed ones."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    population = [best_fit(order, sizes, capacity)] if sizes else [[]]
    if len(population[0]) > lower_bound(sizes, capacity):
        rng = np.random.default_rng(seed)
        noisy = np.array(sizes) if sizes else np.zeros(0)
        for spread in np.linspace(0.05, 0.6, POPULATION - 1):
            keys = noisy * rng.uniform(1 - spread, 1 + spread, len(sizes))
            population.append(best_fit(np.argsort(-keys, kind="stable").tolist(), sizes, capacity))
    return population


def _as_rows(block, island, bins: Bins, frame: pd.DataFrame) -> pd.DataFrame:
    number = np.empty(len(frame), np.int64)
    for k, b in enumerate(bins):
        number[b] = k
    return pd.DataFrame({"block": block, "island": island, "key": frame["key"], "size": frame["size"], "bin": number})


def _bins(frame: pd.DataFrame, column: str) -> Bins:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(frame[column].tolist()):
        out.setdefault(k, []).append(i)
    return list(out.values())


_ROWS = "block long, island int, key long, size long, bin long"


def _pack_blocks(items: DataFrame, capacity: int, seed: int) -> DataFrame:
    """(key, size, block, bin) for items (key, size, block), each block packed by its islands."""
    def begin(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "key"]).reset_index(drop=True)
        sizes = frame["size"].tolist()
        start = first_population(sizes, capacity, seed + int(key[1]))
        return _as_rows(key[0], key[1], evolve(sizes, capacity, start, seed + int(key[1]))[0], frame)

    def epoch(number: int):
        def run(key, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["size", "key"]).reset_index(drop=True)
            sizes = frame["size"].tolist()
            mine, elite = _bins(frame, "bin"), _bins(frame, "elite")
            step = seed + 1000 * number + int(key[1])
            start = [mine, elite, *first_population(sizes, capacity, step)[1:2]]
            return _as_rows(key[0], key[1], evolve(sizes, capacity, start, step)[0], frame)
        return run

    def best(rows: DataFrame) -> DataFrame:
        used = rows.groupBy("block", "island").agg((F.max("bin") + 1).alias("bins"), F.sum("size").alias("tokens"))
        used = used.withColumn("open", F.col("bins") > F.ceil(F.col("tokens") / capacity))
        return used.groupBy("block").agg(F.min_by("island", F.struct("bins", "island")).alias("island"),
                                         F.min(F.col("open").cast("int")).alias("open"))

    island = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    rows = checkpointed(items.select("key", "size", "block", island).groupBy("block", "island")
                        .applyInPandas(begin, _ROWS))
    finished = None
    for number in range(1, EPOCHS + 1):
        chosen = checkpointed(best(rows))
        closed = rows.join(chosen.filter("open = 0").drop("open"), ["block", "island"], "left_semi")
        finished = closed if finished is None else finished.union(closed)
        still = chosen.filter("open = 1").select("block")
        if still.isEmpty():
            return finished.select("key", "size", "block", "bin")
        rows = rows.join(still, "block", "left_semi")
        elite = rows.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), "key",
                            F.col("bin").alias("elite"))
        rows = checkpointed(rows.join(elite, ["block", "island", "key"]).groupBy("block", "island")
                            .applyInPandas(epoch(number), _ROWS))
    rest = rows.join(best(rows).drop("open"), ["block", "island"], "left_semi")
    return finished.union(rest).select("key", "size", "block", "bin")


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """(key, sequence_id, offset) for items (key, size): key unique, size from 1 to `capacity`.

    The items of a sequence lie without gaps from offset 0, by key. An empty table packs into none.
    """
    full = items.filter(F.col("size") >= capacity).select(
        "key", "size", F.lit(-1).cast("long").alias("block"), F.col("key").alias("bin"))
    loose = checkpointed(items.filter(F.col("size") < capacity).select("key", "size"))
    blocks = max(1, -(-loose.count() // block))
    dealt = loose.withColumn("block", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(blocks)))
    packed = checkpointed(_pack_blocks(dealt, capacity, seed))
    level, done = 1, full
    while blocks > 1:
        # Bins less than nine tenths full meet those of other blocks, ever fewer blocks at a time.
        fill = packed.groupBy("block", "bin").agg(F.sum("size").alias("fill"))
        poor = fill.filter(F.col("fill") < 0.9 * capacity).select("block", "bin")
        again = checkpointed(packed.join(poor, ["block", "bin"], "left_semi").select("key", "size"))
        n = again.count()
        fewer = max(1, min(blocks // 2, -(-n // block)))
        if not n:
            break
        # Bins that are full enough are never written again.
        done = done.unionByName(packed.join(poor, ["block", "bin"], "left_anti"))
        dealt = again.withColumn("block", level * 2 ** 40 + F.pmod(F.xxhash64("key", F.lit(seed + level)), F.lit(fewer)))
        packed = checkpointed(_pack_blocks(dealt, capacity, seed + level))
        blocks, level = fewer, level + 1
    # A sequence is named by its smallest key; it holds `capacity` pieces at most.
    inside = Window.partitionBy("block", "bin")
    before = F.sum("size").over(inside.orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    return done.unionByName(packed).select("key", F.min("key").over(inside).alias("sequence_id"),
                                           F.coalesce(before, F.lit(0)).cast("long").alias("offset"))


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                     tokenizer: str = TOKENIZER, block: int = BLOCK) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty: its document is the end id alone. Repeated rows and null ids are
    documents of their own.
    """
    cut = docs.select(F.col(id_col).alias("doc_id"), F.explode(pieces_column(F.col(text_col), capacity, tokenizer))
                      .alias("p")).select("doc_id", "p.*")
    pieces = checkpointed(cut.withColumn("key", F.monotonically_increasing_id()))
    items = pieces.select("key", F.col("length").alias("size"))
    return (pieces.join(pack(items, capacity, block), "key")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
