"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Words of equal length advance together, one position at a time: substring hashes probe the sorted
keys of the pieces, and at each position the best last piece of every word is kept as a backpointer.

In a unigram model the best is the highest sum of scores. In a BPE model it is the only last piece
that merging would leave: a split into pieces is the one that merging gives if and only if each
piece is whole by itself and no merge crosses the seam of two neighbours (`Model.seam_holds`), so
that the search keeps the longest piece that stands beside the best split of what is before it.
"""

import heapq
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: Longer words, and those with more than one leading space, are merged one by one.
MAX_BATCHED = 48
#: A worker's memory of words, as entries; words out of use go when it is full, which costs time only.
CACHE_WORDS = 1_000_000
TOGETHER = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_NEVER = 1 << 40


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one serialised message."""
    at = 0

    def number():
        nonlocal at
        shift = value = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at:at + size]
        at += size


class Model:
    """Pieces of a model file with what the search needs of them."""

    def __init__(self, data: bytes):
        self.texts, scores, kinds = [], [], []
        options, rules = {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                options = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        if rules.get(2) or rules.get(4, 1) or not rules.get(3, 1) or not options.get(35, 0) or USER in kinds:
            raise ValueError("only models with byte fallback, a first space and no text rewriting are read")
        self.unigram = options.get(3, 1) == 1
        self.scores = np.array(scores)
        self.kinds = np.array(kinds)
        self.ids = {t: i for i, t in enumerate(self.texts) if kinds[i] == NORMAL}
        self.bytes = np.zeros(256, np.int64)
        for i in np.flatnonzero(self.kinds == BYTE):
            self.bytes[int(self.texts[i][3:5], 16)] = i
        self.raw = [self._raw(t, k) for t, k in zip(self.texts, kinds)]
        self.unknown = -1 if self.unigram is False else float(self.scores[self.kinds == NORMAL].min()) - 10
        self._keys()
        if not self.unigram:
            self._merges()

    @staticmethod
    def _raw(text: str, kind: int) -> bytes:
        """What a piece adds to a decoded text."""
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        return {UNKNOWN: " ⁇ ", CONTROL: ""}.get(kind, text.replace(SPACE, " ")).encode()

    def _keys(self) -> None:
        by_size = defaultdict(list)
        for t, i in self.ids.items():
            by_size[len(t)].append((int(_hashes(np.array([[ord(c) for c in t]], np.uint64))[0, -1]), i))
        self.longest = max(by_size, default=1)
        self.keys = {n: (np.array([k for k, _ in sorted(x)], np.uint64), np.array([i for _, i in sorted(x)]))
                     for n, x in by_size.items()}

    def _merges(self) -> None:
        """Ranks (characters -1), the two halves that merging makes each piece of, and all seams that merge."""
        n = len(self.texts)
        order = np.argsort(-self.scores, kind="stable")
        self.rank = np.full(n, -1)
        self.rank[order] = np.arange(n)
        self.half = np.full((2, n), -1)
        seams = []
        for t, i in self.ids.items():
            if len(t) == 1:
                self.rank[i] = -1
                continue
            for cut in range(1, len(t)):
                a, b = self.ids.get(t[:cut]), self.ids.get(t[cut:])
                if a is not None and b is not None:
                    seams.append((a * n + b, i))
        self.seams = np.array(sorted(seams), np.int64).reshape(-1, 2)
        self.whole = np.zeros(n, bool)
        for t, i in self.ids.items():
            if len(t) == 1:
                self.whole[i] = True
            elif SPACE * 2 not in t:
                last = self.merged(t, i)
                if len(last) == 2:
                    self.half[:, i], self.whole[i] = last, True

    def merged(self, word: str, without: int = -1) -> list[int]:
        """The pieces that merging the best neighbours leaves, leftmost first; unknown characters
        are -1 - code point. Pieces ranked as `without` or later are not made."""
        pieces = [self.ids.get(c, -1 - ord(c)) for c in word]
        texts, after = list(word), list(range(1, len(word) + 1))
        before, alive = list(range(-1, len(word) - 1)), [True] * len(word)
        score, todo = self.scores, []

        def offer(a):
            b = after[a]
            if b < len(texts):
                i = self.ids.get(texts[a] + texts[b])
                if i is not None and (without < 0 or score[i] > score[without]):
                    heapq.heappush(todo, (-score[i], a, b, len(texts[a]) + len(texts[b]), i))

        for a in range(len(word)):
            offer(a)
        while todo:
            _, a, b, size, i = heapq.heappop(todo)
            if not alive[a] or not alive[b] or after[a] != b or len(texts[a]) + len(texts[b]) != size:
                continue
            texts[a] += texts[b]
            pieces[a], alive[b], after[a] = i, False, after[b]
            if after[b] < len(texts):
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [p for p, x in zip(pieces, alive) if x]

    def seam_holds(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of pieces as two.

        The last merges of the two are undone one by one, the latest first. A pair that stood at the
        seam in between would have merged if that came before the next merge of either half; among
        equal merges the leftmost is first.
        """
        n = len(self.texts)
        holds = np.ones(len(left), bool)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        a, b = left[at], right[at]
        next_a, next_b = np.full(len(at), _NEVER), np.full(len(at), _NEVER)
        while len(at):
            key = a * n + b
            place = np.minimum(np.searchsorted(self.seams[:, 0], key), len(self.seams) - 1)
            hit = self.seams[place, 0] == key
            made = np.where(hit, self.rank[self.seams[place, 1]], _NEVER)
            crosses = (made < next_a) & (made <= next_b) & hit
            holds[at[crosses]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~crosses & ((ra >= 0) | (rb >= 0))
            at, a, b, next_a, next_b, ra, rb = (x[on] for x in (at, a, b, next_a, next_b, ra, rb))
            undo_b = rb >= ra
            next_a, next_b = np.where(undo_b, next_a, ra), np.where(undo_b, rb, next_b)
            a, b = np.where(undo_b, a, self.half[1][a]), np.where(undo_b, self.half[0][b], b)
        return holds

    def probe(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """The pieces of `size` characters with these hashes; -1 where there is none."""
        if size not in self.keys:
            return np.full(len(hashes), -1)
        keys, ids = self.keys[size]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, ids[at], -1)

    def search(self, words: list[str]) -> list[list[int]]:
        """The best split of words of one length; unknown characters are -1 - code point."""
        n, size = len(words), len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(n, size).astype(np.uint64)
        upto = _hashes(points)
        back = np.zeros((n, size + 1), np.int64)
        last = np.full((n, size + 1), -1)
        best = np.zeros((n, size + 1))
        for end in range(1, size + 1):
            open_ = np.arange(n)
            best[:, end] = -np.inf
            for length in range(min(end, self.longest), 0, -1):
                begin = end - length
                piece = self.probe(_between(upto, open_, begin, end), length)
                if length == 1:
                    piece = np.where(piece < 0, -1 - points[open_, begin].astype(np.int64), piece)
                    rows, piece = open_, piece
                else:
                    rows, piece = open_[piece >= 0], piece[piece >= 0]
                if not len(rows):
                    continue
                if self.unigram:
                    total = best[rows, begin] + np.where(piece < 0, self.unknown, self.scores[piece])
                    good = total > best[rows, end]
                    best[rows[good], end] = total[good]
                else:
                    good = np.where(piece >= 0, self.whole[piece], True)
                    if begin:
                        good &= self.seam_holds(last[rows, begin], piece)
                    open_ = np.setdiff1d(open_, rows[good], assume_unique=True)
                back[rows[good], end], last[rows[good], end] = length, piece[good]
                if not len(open_):
                    break
        return [_walk(b, p, size) for b, p in zip(back.tolist(), last.tolist())]

    def split(self, words: list[str]) -> list[list[int]]:
        """The pieces of each word, bytes standing for unknown characters."""
        found: dict[str, list[int]] = {}
        by_size = defaultdict(list)
        for w in words:
            if not self.unigram and (len(w) > MAX_BATCHED or SPACE * 2 in w):
                found[w] = self.merged(w)
            else:
                by_size[len(w)].append(w)
        for alike in by_size.values():
            found.update(zip(alike, self.search(alike)))
        return [self._with_bytes(found[w]) for w in words]

    def _with_bytes(self, pieces: list[int]) -> list[int]:
        if min(pieces, default=0) >= 0:
            return pieces
        return [i for p in pieces for i in ([p] if p >= 0 else self.bytes[list(_utf8(-1 - p))].tolist())]

    def decode(self, ids: list[int]) -> str:
        """The text of pieces, without the space put first; invalid bytes become U+FFFD."""
        joined = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if self.raw[i]), -1)
        if first >= 0 and self.kinds[first] == NORMAL:
            joined = joined.removeprefix(b" ")
        return joined.decode("utf-8", "replace")


def _utf8(code: int) -> bytes:
    return chr(code).encode("utf-8", "replace")


def _hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of all beginnings of each row of code points, the empty one first."""
    out = np.zeros((len(points), points.shape[1] + 1), np.uint64)
    for i in range(points.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + points[:, i] + np.uint64(1)
    return out


def _between(upto: np.ndarray, rows: np.ndarray, begin: int, end: int) -> np.ndarray:
    """The hashes of the characters from begin to end."""
    power = np.uint64(pow(int(_BASE), end - begin, 1 << 64))
    return upto[rows, end] - upto[rows, begin] * power


def _walk(back: list[int], last: list[int], size: int) -> list[int]:
    out = []
    while size:
        out.append(last[size])
        size -= back[size]
    return out[::-1]


class Encoder:
    """Ids of texts, looked up by words; new words are searched many at a time.

    A word's ids are kept as the bytes of little-endian 32-bit numbers.
    """

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [np.frombuffer(x, "<u4").tolist() for x in self.encode_bytes(texts)]

    def encode_bytes(self, texts: list[str | None]) -> Iterator[bytes]:
        some, size = [], 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size > TOGETHER:
                yield from self._together(some)
                some, size = [], 0
        yield from self._together(some)

    def _together(self, texts: list[str]) -> list[bytes]:
        split = [_WORDS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        distinct = set().union(*split) if split else set()
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > CACHE_WORDS:
            # What is still in use stays.
            self.known = {w: self.known[w] for w in distinct if w in self.known}
        self.known.update(zip(new, (struct.pack(f"<{len(x)}I", *x) for x in self.model.split(new))))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str = MODEL) -> Encoder:
    """One for each worker process, so that later tasks find the words of earlier ones."""
    if name not in _ENCODERS:
        with open(tokenizer_path(name), "rb") as file:
            _ENCODERS[name] = Encoder(Model(file.read()))
    return _ENCODERS[name]


def encode_column(text: Column, model: str = MODEL) -> Column:
    """The ids of a text; none for a null one."""
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([np.frombuffer(x, "<i4") for x in encoder(model).encode_bytes(list(batch))], dtype=object)
    return run(text.cast("string"))


def decode_column(ids: Column, model: str = MODEL) -> Column:
    """The text of an array of ids; null for null."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            own = encoder(model).model
            yield pd.Series([None if x is None else own.decode(x) for x in batch], dtype=object)
    return run(ids)


def encoded_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip) of each row of `docs`.

    `ids_crc32` is of the ids as little-endian unsigned 32-bit numbers, `round_trip` whether
    decoding gives the text again. A null text counts as empty and has no ids.
    """
    @F.pandas_udf("n_tokens long, ids_crc32 long, round_trip boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(model)
        for batch in batches:
            texts = [t or "" for t in batch]
            rows = [(len(x) // 4, zlib.crc32(x), own.model.decode(np.frombuffer(x, "<u4").tolist()) == t)
                    for t, x in zip(texts, own.encode_bytes(texts))]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_crc32", "round_trip"])
    return docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col).cast("string")).alias("e")).select(
        "doc_id", "e.*")
