"""Language by unigram pieces, summed over all segmentations.

The pieces are the tokens of a fixed public vocabulary of up to ``LONGEST`` bytes, and all single bytes.  Each language has a
probability per piece, learnt by expectation maximisation.  A word's probability is the sum over all
its segmentations (the forward algorithm); a text's is the product over its words.  The most
likely language is the answer, its posterior the score.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import Words, blocks, text_bytes
from .storage import id_bucket

LONGEST = 8
#: A longer run of letters is taken as several words of this many bytes, so that the work on a word is bounded.
WORD_BYTES = 24
#: Bound of the training sample: documents of each language, the first by a hash of their id.
SAMPLE_ROWS = 300
ROUNDS = 4
FLOOR = 0.02
CACHE = 400_000
#: All ASCII but letters.
NO_LETTER = bytes(b for b in range(128) if not chr(b).isalpha())


def read_pieces(path: str) -> list[bytes]:
    """Tokens of a rank file (base64, rank), lower-cased, with the single bytes first."""
    with open(path, "rb") as lines:
        tokens = {base64.b64decode(line.split()[0]).lower() for line in lines}
    single = [bytes([b]) for b in range(256)]
    return single + sorted(t for t in tokens if 1 < len(t) <= LONGEST)


class Pieces:
    """Looks up substrings of padded words, each packed into one number."""

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        self.by_length = []
        for k in range(1, LONGEST + 1):
            own = sorted((int.from_bytes(p, "big"), i) for i, p in enumerate(pieces) if len(p) == k)
            self.by_length.append((np.array([x for x, _ in own], np.uint64), np.array([i for _, i in own], np.int32)))
        slots = 1 << 20
        self.maybe = []  # a quick no for most substrings
        for keys, _ in self.by_length:
            bits = np.zeros(slots, bool)
            bits[self._slot(keys)] = True
            self.maybe.append(bits)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def cells(self, words: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For words (n, width) in bytes: (end, size, rows, pieces) of all pieces inside, by rising end."""
        width = words.shape[1]
        wide = words.astype(np.uint64)
        for end in range(1, width + 1):
            packed = np.zeros(len(words), np.uint64)
            alive = np.flatnonzero(lengths >= end)
            if not len(alive):
                return
            for size in range(1, min(end, LONGEST) + 1):
                packed[alive] |= wide[alive, end - size] << np.uint64(8 * (size - 1))
                keys, ids = self.by_length[size - 1]
                if not len(keys):
                    continue
                rows = alive[self.maybe[size - 1][self._slot(packed[alive])]]
                at = np.minimum(np.searchsorted(keys, packed[rows]), len(keys) - 1)
                ok = keys[at] == packed[rows]
                yield end, size, rows[ok], ids[at[ok]]


def forward(cells: list[tuple[int, int, np.ndarray, np.ndarray]] | Iterator, n: int, width: int, chance: np.ndarray) -> np.ndarray:
    """chance (pieces, languages); alpha (end, word, language): summed probability of the first ``end`` bytes."""
    alpha = np.zeros((width + 1, n, chance.shape[1]))
    alpha[0] = 1
    for end, size, rows, pieces in cells:
        alpha[end, rows] += alpha[end - size, rows] * chance[pieces]
    return alpha


def word_matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    columns = np.arange(int(lengths.max()) if len(lengths) else 1)
    places = np.minimum(starts[:, None] + columns, max(len(data) - 1, 0))
    return np.where(columns < lengths[:, None], data[places], 0)


def spans(cutter: Words, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of words of at most WORD_BYTES."""
    starts, ends = cutter.spans(data, offsets)
    parts = -(-(ends - starts) // WORD_BYTES)
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, ends = np.repeat(starts, parts) + nth * WORD_BYTES, np.repeat(ends, parts)
        ends = np.minimum(ends, starts + WORD_BYTES)
    return starts, ends - starts


def learn(texts: list[str], pieces: Pieces) -> np.ndarray:
    """Probability of each piece by expectation maximisation over all segmentations of one language's words."""
    cutter = Words(NO_LETTER)
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    data = cutter.lower[data[: offsets[-1]]]
    starts, lengths = spans(cutter, data, offsets)
    chance = np.full((pieces.n, 1), 1 / pieces.n)
    if not len(starts):
        return chance[:, 0]
    hashes = cutter.hashes(data, starts, starts + lengths)
    _, where, times = np.unique(hashes, return_index=True, return_counts=True)
    for _ in range(ROUNDS):
        counts = np.zeros(pieces.n)
        for part in np.array_split(np.arange(len(where)), len(where) // 20000 + 1):
            size, weight = lengths[where[part]], times[part]
            cells = list(pieces.cells(word_matrix(data, starts[where[part]], size), size))
            width = int(size.max())
            alpha = forward(cells, len(part), width, chance)[:, :, 0]
            beta = np.zeros((width + 1, len(part)))
            beta[size, np.arange(len(part))] = 1
            total = weight / alpha[size, np.arange(len(part))]
            for end, k, rows, ids in reversed(cells):
                use = chance[ids, 0] * beta[end, rows]
                counts += np.bincount(ids, alpha[end - k, rows] * use * total[rows], pieces.n)
                np.add.at(beta[end - k], rows, use)
        chance[:, 0] = (1 - FLOOR) * counts / counts.sum() + FLOOR / pieces.n
    return chance[:, 0]


class Scorer:
    """Log probabilities of texts per language, with those of words kept for the next batch."""

    def __init__(self, pieces: Pieces, chance: np.ndarray):
        self.pieces, self.chance, self.cutter = pieces, chance, Words(NO_LETTER)
        self.keys, self.values = np.empty(0, np.uint64), np.empty((0, chance.shape[1]), np.float32)

    def words(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty((len(starts), self.chance.shape[1]), np.float32)
        order = np.argsort(lengths, kind="stable")  # words of like length share a matrix
        for part in np.array_split(order, len(order) // 8000 + 1):
            if not len(part):
                continue
            size = lengths[part]
            width = int(size.max())
            cells = self.pieces.cells(word_matrix(data, starts[part], size), size)
            out[part] = np.log(forward(cells, len(part), width, self.chance)[size, np.arange(len(part))])
        return out

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        low = offsets[0]
        data, offsets = self.cutter.lower[data[low : offsets[-1]]], offsets - low
        starts, lengths = spans(self.cutter, data, offsets)
        total = np.zeros((len(offsets) - 1, self.chance.shape[1]))
        if not len(starts):
            return total
        unique, where, inverse = np.unique(self.cutter.hashes(data, starts, starts + lengths), return_index=True, return_inverse=True)
        values = np.empty((len(unique), self.chance.shape[1]), np.float32)
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == unique[inside]
        values[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        values[new] = self.words(data, starts[where[new]], lengths[where[new]])
        if len(self.keys) + len(new) > CACHE:
            self.keys, self.values = unique, values
        else:
            self.keys, self.values = np.insert(self.keys, at[new], unique[new]), np.insert(self.values, at[new], values[new], axis=0)
        doc = np.searchsorted(offsets, starts, "right") - 1
        each = values[inverse].astype(np.float64)
        for k in range(total.shape[1]):
            total[:, k] = np.bincount(doc, each[:, k], len(total))
        return total


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, list[str]]:
    """At most SAMPLE_ROWS texts of each language."""
    order = F.xxhash64(F.lit("language"), F.col("id"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL")
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())  # a handful of languages
    found = {}
    for lang in langs:
        ids = rows.filter(F.col("lang") == lang).select("id").distinct().orderBy(order, "id").limit(SAMPLE_ROWS)
        own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(F.col("lang") == lang)
        texts = own.join(F.broadcast(ids), "id").orderBy("id", "text").limit(SAMPLE_ROWS)
        found[lang] = [r.text or "" for r in texts.collect()]
    return found


def languages(
    docs: DataFrame, vocabulary: str, folds: int = 3, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    Learns from rows with a language whose crc32 of the id modulo ``folds`` is not ``held_out``.  Words are runs of ASCII
    letters and non-ASCII bytes, A-Z lower-cased.  ``und`` with score 0 if the text is null or has no letter, or if there is
    nothing to learn from; ties go to the first name.  Ids may be null or repeat.  An empty table gives no rows.
    """
    pieces = read_pieces(vocabulary)
    look = Pieces(pieces)
    rows = docs.filter(id_bucket(F.col(id_col), folds) != held_out)
    texts = {k: v for k, v in sample(rows, id_col, text_col, lang_col).items() if v}
    names = sorted(texts)
    chance = np.stack([learn(texts[k], look) for k in names], axis=1) if names else np.zeros((look.n, 0))
    shipped = docs.sparkSession.sparkContext.broadcast((pieces, names, chance.astype(np.float64)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, names, chance = shipped.value
        scorer = Scorer(Pieces(own), chance) if names else None
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            letter = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            for first, last in blocks(offsets):
                n, ok = last - first, letter[first:last]
                best, score = np.full(n, "und", object), np.zeros(n)
                if scorer is not None:
                    logs = scorer.texts(data, offsets[first : last + 1])
                    odds = np.exp(logs - logs.max(axis=1, keepdims=True))
                    top = odds.argmax(axis=1)
                    best[ok] = np.array(names, object)[top][ok]
                    score[ok] = (1 / odds.sum(axis=1))[ok]
                yield pa.RecordBatch.from_pydict(
                    {id_col: batch.column("id").slice(first, n), "lang_pred": pa.array(best.tolist(), pa.string()), "score": score}
                )

    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), letter.alias("letter"))
    found = read.mapInArrow(predict, f"`{id_col}` long, lang_pred string, score double")
    return found.select(id_col, (id_bucket(F.col(id_col), folds) == held_out).alias("held_out"), "lang_pred", "score")
