"""Toxicity: a convolutional text classifier trained on shards of all labelled texts.

A text's lower-cased words are hashed: the word itself and its first three to seven letters
each have a 64-bit key, and a word's embedding is the sum of the learnt rows of its keys
(nothing for keys that were not learnt).  Filters one, two and three words wide slide over
the whole text, max pooling keeps each filter's strongest answer, and a logistic layer
weighs them.  The score is the sigmoid of the logit less the threshold calibrated for the
text's language, so 0.5 is the decision everywhere.  The language is guessed from the
text's function words; no column but the text is an input.

Training takes every labelled row outside the held-out fold.  Keys are counted over all of
them by a shuffle; then shards of rows descend side by side from one start, and what they
changed is averaged; the thresholds are those with the fewest errors over all rows
kept from the fit.  The model has a bounded size (``Settings``) and is broadcast.  Scoring
maps over all texts, block by block, without a shuffle.

NULL and empty texts have no words: pooling then gives zeros and the score is the model's
answer to nothing.  Without labels of both kinds every score is the share of toxic labels
(0 where there are none).  Rows that repeat an id are scored one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from starkpi.llm.common import map_arrow, materialize
from starkpi.operators.bitmaps import id_bitmaps

_WORD = re.compile(r"[^\W_]+")
# Frequent function words, for the guess at a text's language.
FUNCTION_WORDS = {
    "en": "the and of to in is that for was with on by are this it as",
    "fr": "le la les des et que qui dans une du au par pour avec un",
    "de": "der die das und mit den von ist ein zu auf für im dem des sich",
    "es": "el los las por con para una del como se su no es lo",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
_LANGUAGE_OF: dict[str, int] = {}
for _number, _words in enumerate(FUNCTION_WORDS.values()):
    for _word in _words.split():
        _LANGUAGE_OF.setdefault(_word, _number)
PREFIXES = range(3, 8)


@dataclass(frozen=True)
class Settings:
    """Size of the model and of its training; all bounds are independent of the input."""
    dim: int = 8                # embedding width
    filters: int = 8            # filters of each width
    widths: tuple = (1, 2, 3)
    shard_rows: int = 8000      # labelled rows that one task descends on, about
    block_words: int = 8_000_000  # words that it holds at once, about
    least_texts: int = 3        # keys in fewer texts are not learnt
    most_keys: int = 200_000    # keys learnt, those in most texts first
    epochs: int = 2
    batch: int = 64
    rate: float = 0.05
    seed: int = 7


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def keys_of(word: str) -> list[int]:
    """The word's key, then those of its prefixes."""
    return [xxhash.xxh64_intdigest(word, 1)] + [xxhash.xxh64_intdigest(word[:n], 2) for n in PREFIXES if len(word) >= n]


@dataclass
class Model:
    settings: Settings
    keys: np.ndarray = None                    # learnt keys, sorted
    table: np.ndarray = None                   # a row per key and a last one of zeros
    conv: list = field(default_factory=list)   # per width: (width, dim, filters)
    bias: list = field(default_factory=list)   # per width: (filters,)
    out: np.ndarray = None
    out_bias: float = 0.0
    threshold: np.ndarray = None               # logit per language
    constant: float | None = None              # the score where nothing could be learnt

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Table rows (words, 1 + prefixes) of each word's keys; the zero row where not learnt."""
        width = 1 + len(PREFIXES)
        keys = np.zeros((len(words), width), np.uint64)
        real = np.zeros(keys.shape, bool)
        for i, w in enumerate(words):
            own = keys_of(w)
            keys[i, :len(own)] = own
            real[i, :len(own)] = True
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        found = real & (self.keys[at] == keys) if len(self.keys) else np.zeros(keys.shape, bool)
        return np.where(found, at, len(self.keys))

    def answers(self, emb: np.ndarray, live: np.ndarray, i: int) -> np.ndarray:
        """What the filters of the i-th width say at every position."""
        out = np.zeros((len(emb), self.settings.filters), np.float32)
        for j in range(self.settings.widths[i]):
            out[:len(emb) - j] += emb[j:] @ self.conv[i][j]
        out += self.bias[i]
        out[~live] = -np.inf
        return out

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.out + self.out_bias


def lay_out(texts: list[np.ndarray], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, ``gap`` empty places behind each, so that no filter sees
    two of them: (word numbers, whether a place holds a word, first places)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + gap)])
    words, live = np.zeros(starts[-1], np.int64), np.zeros(starts[-1], bool)
    for at, t in zip(starts, texts):
        words[at:at + len(t)] = t
        live[at:at + len(t)] = True
    return words, live, starts[:-1]


class Scorer:
    """A model at work in one task: embeddings and language marks of the words met so far,
    for a bounded number of words."""

    def __init__(self, model: Model, entries: int = 200_000, longest: int = 200_000):
        self.model, self.entries, self.longest = model, entries, longest
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.vectors = np.zeros((1024, self.model.settings.dim), np.float32)
        self.marks = np.full(1024, -1, np.int8)

    def _numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if fresh := [w for w in dict.fromkeys(words) if w not in self.number]:
            first, last = len(self.number), len(self.number) + len(fresh)
            while last > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                self.marks = np.concatenate([self.marks, np.full(len(self.marks), -1, np.int8)])
            self.vectors[first:last] = self.model.table[self.model.rows_of(fresh)].sum(axis=1)
            self.marks[first:last] = [_LANGUAGE_OF.get(w, -1) for w in fresh]
            self.number.update(zip(fresh, range(first, last)))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _language(self, text: np.ndarray) -> int:
        marks = np.bincount(self.marks[text] + 1, minlength=len(LANGUAGES))[1:]
        return int(marks.argmax()) if marks.any() else len(LANGUAGES) - 1

    def _pooled(self, texts: list[np.ndarray], own: int) -> np.ndarray:
        """Filters open at the first ``own`` words of a text only; what follows is overlap."""
        s = self.model.settings
        out = np.zeros((len(texts), s.filters * len(s.widths)), np.float32)
        full = [i for i, t in enumerate(texts) if len(t)]
        if not full:
            return out
        words, live, starts = lay_out([texts[i] for i in full], max(s.widths))
        emb = self.vectors[words]
        emb[~live] = 0
        for at, i in zip(starts, full):
            live[at + own:at + len(texts[i])] = False
        for i in range(len(s.widths)):
            out[full, i * s.filters:(i + 1) * s.filters] = np.maximum.reduceat(self.model.answers(emb, live, i), starts)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        z, lang = self.logits(texts)
        return 1 / (1 + np.exp(-np.clip(z - self.model.threshold[lang], -30, 30)))

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Logits and languages.  A text beyond ``longest`` words is pooled slice by slice,
        the filters' overlap included."""
        if len(self.number) > self.entries:
            self._forget()
        numbers = [self._numbers(t) for t in texts]
        over, n = max(self.model.settings.widths) - 1, self.longest
        slices = [(i, t[at:at + n + over]) for i, t in enumerate(numbers) for at in range(0, max(len(t), 1), n)]
        top = np.full((len(texts), len(self.model.out)), -np.inf, np.float32)
        for lo, hi in _runs([len(t) for _, t in slices], n):
            np.maximum.at(top, [i for i, _ in slices[lo:hi]], self._pooled([t for _, t in slices[lo:hi]], n))
        return self.model.logit(top), np.array([self._language(t) for t in numbers], dtype=np.int64)


def _runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cuts 0..len(sizes) into runs whose sizes sum to about ``limit``."""
    lo, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


def begin(keys: np.ndarray, has: np.ndarray, toxic: np.ndarray, n_toxic: float, n_rest: float, settings: Settings) -> Model:
    """The network before it is trained, from the learnt ``keys`` (sorted), the texts and the
    toxic texts that have each, and the texts of either label.

    The first embedding column starts as the log odds of a text being toxic if it has the
    key, and the first filter as a look at that column; everything else starts small."""
    s, rng = settings, np.random.default_rng(settings.seed)
    model = Model(s, keys, threshold=np.zeros(len(LANGUAGES)))
    odds = np.log((toxic + 1) / (n_toxic + 2)) - np.log((has - toxic + 1) / (n_rest + 2))
    model.table = np.zeros((len(model.keys) + 1, s.dim), np.float32)
    model.table[:-1] = rng.normal(0, 0.01, (len(model.keys), s.dim))
    model.table[:-1, 0] = odds / 3
    for w in s.widths:
        model.conv.append(rng.normal(0, 0.1, (w, s.dim, s.filters)).astype(np.float32))
        model.bias.append(np.zeros(s.filters, np.float32))
    model.conv[0][0, :, 0] = np.eye(s.dim)[0]
    model.out = rng.normal(0, 0.1, s.filters * len(s.widths)).astype(np.float32)
    model.out[0] = 1.0
    return model


class Descent:
    """Gradient descent with adaptive steps (squared gradients summed up) on a model, in one
    task; ``weights`` are those of the labels 0 and 1."""

    def __init__(self, model: Model, weights: tuple[float, float], rng: np.random.Generator):
        self.model, self.weights, self.rng = model, np.array(weights), rng
        self.params = [model.table, *model.conv, *model.bias, model.out]
        self.past = [np.full(x.shape, 1e-3, np.float32) for x in self.params]
        self.past_bias = 1e-3

    def _move(self, i: int, step: np.ndarray, rows=slice(None)) -> None:
        self.past[i][rows] += step ** 2
        self.params[i][rows] -= self.model.settings.rate * step / np.sqrt(self.past[i][rows])

    def over(self, texts: list[list[str]], labels: np.ndarray) -> None:
        """All epochs over a block of texts, given as words."""
        model, s, move = self.model, self.model.settings, self._move
        number: dict[str, int] = {}
        coded = [np.array([number.setdefault(w, len(number)) for w in t], np.int64) for t in texts]
        key_rows = model.rows_of(list(number))
        weight, zero, nw = self.weights[labels.astype(int)], len(model.keys), len(s.widths)
        for _ in range(s.epochs):
            for batch in np.array_split(self.rng.permutation(len(coded)), max(1, len(coded) // s.batch)):
                batch = [i for i in batch if len(coded[i])]
                if not batch:
                    continue
                words, live, starts = lay_out([coded[i] for i in batch], max(s.widths))
                own, place = np.unique(words, return_inverse=True)
                emb = model.table[key_rows[own]].sum(axis=1)[place]
                emb[~live] = 0
                top = np.empty((len(batch), s.filters * nw), np.float32)
                where = np.empty(top.shape, np.int64)
                for i in range(nw):
                    said, cols = model.answers(emb, live, i), slice(i * s.filters, (i + 1) * s.filters)
                    for k, at in enumerate(starts):
                        part = said[at:at + len(coded[batch[k]])]
                        where[k, cols] = at + part.argmax(axis=0)
                        top[k, cols] = part.max(axis=0)
                pooled = np.maximum(top, 0)
                z = model.logit(top)
                y = labels[batch]
                err = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight[batch] / len(batch)).astype(np.float32)
                back = err[:, None] * model.out * (top > 0)
                move(1 + 2 * nw, err @ pooled + 1e-4 * model.out)
                self.past_bias += float(err.sum()) ** 2
                model.out_bias -= s.rate * float(err.sum()) / self.past_bias ** 0.5
                places, steps = [], []
                for i in range(nw):
                    cols = slice(i * s.filters, (i + 1) * s.filters)
                    move(1 + nw + i, back[:, cols].sum(axis=0))
                    t, f = np.nonzero(back[:, cols])
                    g, at = back[:, cols][t, f][:, None], where[:, cols][t, f]
                    grad = np.zeros_like(model.conv[i])
                    for j in range(s.widths[i]):
                        by_filter = np.zeros((s.filters, s.dim), np.float32)
                        np.add.at(by_filter, f, g * emb[at + j])
                        grad[j] = by_filter.T
                        places.append(at + j)
                        steps.append(g * model.conv[i][j][:, f].T)
                    move(1 + i, grad)
                places, steps = np.concatenate(places), np.concatenate(steps)
                keep = live[places]
                rows = key_rows[words[places[keep]]]
                row, inverse = np.unique(rows.ravel(), return_inverse=True)
                grad = np.zeros((len(row), s.dim), np.float32)
                np.add.at(grad, inverse, np.repeat(steps[keep], rows.shape[1], axis=0))
                real = row != zero
                move(0, grad[real], row[real])


_CELL, _CELLS = 1 / 1024, 1 << 15  # logits are counted in cells this wide, this many on either side of 0


def _thresholds(cell: np.ndarray, lang: np.ndarray, rest: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Per language the logit with the fewest errors, the middle of the widest gap where
    several have them; languages with few rows of a label share the overall one.  Given are
    the cells of logits that occur, by language, and how many texts of either label each has."""
    def best(own):
        at, inverse = np.unique(cell[own], return_inverse=True)
        n0, n1 = np.bincount(inverse, rest[own]), np.bincount(inverse, toxic[own])
        # the threshold lies below all cells, between two of them or above all
        cost = np.concatenate([[0], np.cumsum(n1)]) + n0.sum() - np.concatenate([[0], np.cumsum(n0)])
        edges = np.concatenate([[at[0] - 1024.0], (at[1:] + at[:-1] + 1) / 2, [at[-1] + 1025.0]])
        width = np.concatenate([[0], at[1:] - at[:-1], [0]])
        good = np.flatnonzero(cost == cost.min())
        return edges[good[width[good].argmax()]] * _CELL

    out = np.full(len(LANGUAGES), best(np.ones(len(cell), bool)))
    for i in range(len(LANGUAGES)):
        if min(toxic[lang == i].sum(), rest[lang == i].sum()) >= 20:
            out[i] = best(lang == i)
    return out


# ---- on Spark ---------------------------------------------------------------


def in_fold(id_col: Column) -> Column:
    """Whether a row is held out of training: crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


_SIEVE = 1 << 26  # bits of the sieve of labelled ids, 8 MB


def labelled_first(texts: DataFrame, lab: DataFrame, key: str = "__id") -> DataFrame:
    """``texts`` without most rows whose ``key`` is not in ``lab``, so that they take no part in
    the shuffle to their labels.  Each labelled key sets a bit by its hash; the bits, of bounded
    size, are broadcast.  Rows that hit a bit by chance stay, for the join to drop."""
    kind = texts.schema[key].dataType
    if kind != lab.schema[key].dataType or not isinstance(kind, IntegralType | StringType):
        return texts  # equal keys might hash differently
    bit = F.pmod(F.xxhash64(key), F.lit(_SIEVE))
    sieve = id_bitmaps(lab, bit, [])
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = texts.join(F.broadcast(sieve), F.bitmap_bucket_number(bit) == F.col("__chunk"))
    return hit.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*texts.columns)


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(__id, __text, __y, __spare) of every labelled row outside the held-out fold.  An id
    labelled twice counts as toxic if either label says so, and one with several texts has the
    smallest; NULL labels and ids are left out.  ``__spare`` marks the seventh part that is kept
    from the fit, for the thresholds."""
    def trains(c):
        return F.col(c).isNotNull() & ~in_fold(F.col(c))
    lab = labels.where(F.col(label_col).isNotNull() & trains(id_col))
    lab = lab.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__y"))
    texts = docs.where(trains(id_col)).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = labelled_first(texts, lab).join(lab, "__id").groupBy("__id").agg(F.min("__text").alias("__text"), F.first("__y").alias("__y"))
    return rows.sortWithinPartitions(F.xxhash64("__id"), "__id").withColumn(
        "__spare", F.pmod(F.xxhash64("__id", F.lit(settings.seed)), F.lit(100)) < 15)


def key_counts(rows: DataFrame) -> DataFrame:
    """(key, has, toxic): in how many texts each key is, and in how many toxic ones."""
    def emit(parts: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
        keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        y = np.repeat([y for _, y in parts], [len(k) for k, _ in parts])
        return pa.RecordBatch.from_arrays([
            pa.array(keys.view(np.int64)), pa.array(np.bincount(place, minlength=len(keys)).astype(np.int64)),
            pa.array(np.bincount(place, y, minlength=len(keys)).astype(np.int64))], names=["key", "has", "toxic"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[str, list[int]] = {}
        parts, held = [], 0
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = set(words_of(text))
                if len(met) > 200_000:
                    met.clear()
                for w in words:
                    if w not in met:
                        met[w] = keys_of(w)
                parts.append((np.fromiter({k for w in words for k in met[w]}, np.uint64), y))
                held += len(parts[-1][0])
                if held > 8_000_000:  # a bounded number of keys at once
                    yield emit(parts)
                    parts, held = [], 0
        if parts:
            yield emit(parts)

    found = map_arrow(rows.select("__text", "__y"), run, "key long, has long, toxic long")
    return found.groupBy("key").agg(F.sum("has").alias("has"), F.sum("toxic").alias("toxic"))


_BLOCK = 4096  # rows of the table that travel together


def descend(model: Model, rows: DataFrame, weights: tuple[float, float]) -> None:
    """Train ``model`` on all ``rows``: every partition descends from it on its own, a bounded
    number of words at a time, and what they changed is averaged (a key's row over the partitions
    that moved it).  The driver gets one average of the model's size."""
    s = model.settings
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        own = Model(s, start.keys, start.table.copy(), [x.copy() for x in start.conv], [x.copy() for x in start.bias],
                    start.out.copy(), start.out_bias)
        descent, texts, labels, held, seen = Descent(own, weights, np.random.default_rng(s.seed)), [], [], 0, 0
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts.append(words_of(text))
                labels.append(y)
                held, seen = held + len(texts[-1]), seen + 1
                if held > s.block_words:
                    descent.over(texts, np.array(labels, float))
                    texts, labels, held = [], [], 0
        if not seen:
            return  # a partition without rows has no say
        if texts:
            descent.over(texts, np.array(labels, float))
        moved = own.table - start.table
        for at in range(0, len(moved), _BLOCK):
            part = moved[at:at + _BLOCK]
            if part.any():
                yield _bytes(at, np.hstack([part, part.any(axis=1, keepdims=True)]))
        rest = [a - b for a, b in zip([*own.conv, *own.bias, own.out], [*start.conv, *start.bias, start.out])]
        yield _bytes(-1, np.concatenate([*(x.ravel() for x in rest), [own.out_bias - start.out_bias, 1.0]]))

    parts = map_arrow(rows.select("__text", "__y"), run, "at long, moved binary").rdd.map(
        lambda r: (r[0], np.frombuffer(r[1], np.float64)))
    for at, sums in parts.reduceByKey(lambda a, b: a + b).toLocalIterator():
        if at >= 0:
            sums = sums.reshape(-1, s.dim + 1)
            model.table[at:at + len(sums)] += (sums[:, :-1] / np.maximum(sums[:, -1:], 1)).astype(np.float32)
        else:
            mean, done = sums[:-1] / sums[-1], 0
            for x in [*model.conv, *model.bias, model.out]:
                x += mean[done:done + x.size].reshape(x.shape).astype(np.float32)
                done += x.size
            model.out_bias += float(mean[-1])


def _bytes(at: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([values.astype(np.float64).tobytes()], pa.binary())],
                                      names=["at", "moved"])


def calibrate(model: Model, rows: DataFrame) -> None:
    """Thresholds with the fewest errors over all ``rows``, whose logits are counted by cell."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            for lo, hi in _runs(_sizes(b.column(0)), 1 << 20):
                z, lang = scorer.logits(b.column(0).slice(lo, hi - lo).to_pylist())
                cell = np.clip(np.floor(z.astype(float) / _CELL), -_CELLS, _CELLS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(lang), b.column(1).slice(lo, hi - lo)],
                                                 names=["cell", "lang", "y"])

    # at most (2 * _CELLS + 1) * len(LANGUAGES) rows
    counts = map_arrow(rows.select("__text", "__y"), run, "cell long, lang long, y int").groupBy("cell", "lang").agg(
        F.sum(1 - F.col("y")).alias("rest"), F.sum("y").alias("toxic")).toArrow()
    model.threshold = _thresholds(*(counts[c].to_numpy() for c in ("cell", "lang", "rest", "toxic")))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model fitted on every labelled row outside the held-out fold."""
    rows = materialize(training_rows(docs, labels, settings, id_col, text_col, label_col))
    number = {(r[0], r[1]): r[2] for r in rows.groupBy("__spare", "__y").count().collect()}
    n_rest, n_toxic = (sum(n for (_, y), n in number.items() if y == label) for label in (0, 1))
    if not n_rest or not n_toxic:
        return Model(settings, constant=n_toxic / (n_toxic + n_rest) if n_toxic else 0.0)
    fitted = judged = rows
    if min(number.get((True, y), 0) for y in (0, 1)) >= 20:
        fitted, judged = rows.where("NOT __spare"), rows.where("__spare")
        n_rest, n_toxic = number.get((False, 0), 0), number.get((False, 1), 0)
    # as few tasks as shards: keys of many texts are summed up before they travel
    fitted = fitted.coalesce(-(-(n_rest + n_toxic) // settings.shard_rows))
    often = key_counts(fitted).where(F.col("has") >= settings.least_texts).orderBy(F.col("has").desc(), "key").limit(
        settings.most_keys).toArrow()
    keys = often["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    model = begin(keys[order], *(often[c].to_numpy()[order].astype(float) for c in ("has", "toxic")), n_toxic, n_rest, settings)
    # both labels weigh the same
    n = n_toxic + n_rest
    descend(model, fitted, (0.5 * n / max(n_rest, 1), 0.5 * n / max(n_toxic, 1)))
    calibrate(model, judged)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` are left out but ``id_col``: (``id_col``, score double)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_score_texts(scorer, b.column(1)))], names=[id_col, "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, F.col(text_col).cast("string")), run, f"`{id_col}` {id_type}, score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", at_most: float = 0.5) -> DataFrame:
    """``docs``, all columns, without the rows whose score reaches ``at_most``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            yield b.filter(pa.array(_score_texts(scorer, b.column(at)) < at_most))

    return map_arrow(docs, run, docs.schema)


def _sizes(texts: pa.Array) -> list[int]:
    return [len(t.as_buffer()) if t.is_valid else 0 for t in texts]


def _score_texts(scorer: Scorer, texts: pa.Array, block: int = 1 << 20) -> np.ndarray:
    """Scores of a column of texts, in blocks of about ``block`` characters."""
    out = [np.zeros(0)]
    for lo, hi in _runs(_sizes(texts), block):
        out.append(scorer.scores(texts.slice(lo, hi - lo).to_pylist()))
    return np.concatenate(out).astype(float)
