"""Language identification by known words first, then by shorter and shorter character n-grams.

Words are runs of letters, lowered, hashed from code points in NumPy. A word known in some language
scores its log frequency in each; an unseen word scores the mean over its n-grams (with word ends),
of the largest n from 5 to 1 for which any is known. A text's language has the largest sum.

The model is fitted on all labelled rows: their words are counted first, and n-grams over the distinct
words, with their counts. The ``WORDS`` commonest words and ``GRAMS`` commonest n-grams of each length
are kept. Its size therefore depends on the number of languages only, of which the ``LANGUAGES``
commonest are learned.

Whether a text is written in a learned language at all is another question, as some language always
has the largest sum: its *likeness* is the mean log frequency per word of its trigrams in the language
it is most like, which does not grow with the text, and a limit for it is learned from labelled rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerwatch.llm.common import mix, released

#: Distinct words of a language that a task holds before it hands them on.
HELD = 1 << 16
#: So many of the commonest labels are learned, which bounds the model where labels are dirty.
LANGUAGES = 1000
WORDS = 20_000
GRAMS = 6_000
LONGEST = 5
UNKNOWN = "und"
#: Words after which more text no longer sharpens the score.
EVIDENCE = 30
#: Length of the n-grams that likeness looks at.
LIKE = 3
#: A text is unlike the learned ones if its likeness lies so many times further below the median of
#: labelled rows than their lowest twentieth begins; the limit is no nearer than ``LEAST_GAP``, and
#: no lower than ``WORST`` of the way from the median to what wholly unknown words score.
SPREAD = 6.0
LEAST_GAP = 3.5
WORST = 0.75
#: Decimals of a likeness that its quantiles look at, which bounds how many values are counted.
DIGITS = 4
_END = np.uint64(0x2C)
#: Characters, and rows, worked on at once: they bound what a worker holds besides its Arrow batch.
_SLICE, _ROWS = 1 << 17, 512


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD1342543DE82EF95
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _runs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, and where runs of letters begin and end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.zeros(len(points) + 2, np.int8)
    inside[1:-1] = _letters()[points]
    edge = np.diff(inside)
    return points, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(16, int(len(points)).bit_length()))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix(points.astype(np.uint64)) * up[: len(points)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _padded(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with an end mark on both sides, one after another; their places and lengths."""
    length = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(length)])
    out = np.full(int(first[-1]), _END, np.uint64)
    within = np.arange(len(out)) - np.repeat(first[:-1], length)
    core = (within > 0) & (within < np.repeat(length, length) - 1)
    out[core] = points[(np.repeat(starts, length) + within - 1)[core]]
    return mix(out), first, length


def _gram_hashes(padded: np.ndarray, first: np.ndarray, length: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams, and the word each belongs to."""
    count = np.maximum(0, length - n + 1)
    word = np.repeat(np.arange(len(length)), count)
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[:-1], count)
    out = np.full(len(at), n, np.uint64)
    for j in range(n):
        out = out * np.uint64(0xD1342543DE82EF95) + padded[at + j]
    return mix(out), word


@functools.cache
def _end_gram() -> np.uint64:
    return _gram_hashes(mix(np.array([_END])), np.array([0, 1]), np.array([1]), 1)[0][0]


def _cut(text: str) -> Iterator[str]:
    """Slices of about a million characters, cut where letters end."""
    at = 0
    while at < len(text):
        end = min(len(text), at + _SLICE)
        while end < len(text) and text[end].isalpha() and end < at + 2 * _SLICE:
            end += 1
        yield text[at:end]
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of (lang, text) with their numbers, as often as a task's table of them is full."""
    held: dict[str, dict[str, int]] = {}

    def packed(lang: str) -> pa.RecordBatch:
        own = held.pop(lang)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())],
            names=["lang", "word", "n"],
        )

    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            part = batch.slice(first, _ROWS)
            texts: dict[str, list[str]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                for _, pieces in _pieces(own):
                    known = held.setdefault(lang, {})
                    for word, n in _words("\n".join(pieces)):
                        known[word] = known.get(word, 0) + n
                    if sum(map(len, held.values())) > HELD:
                        yield packed(max(held, key=lambda x: len(held[x])))
    for lang in list(held):
        yield packed(lang)


def _words(text: str) -> Iterator[tuple[str, int]]:
    """The distinct words of a text, lowered, and their numbers."""
    points, starts, ends = _runs(text)
    _, one, n = np.unique(_word_hashes(points, starts, ends), return_index=True, return_counts=True)
    lowered = text.lower()
    for a, b, k in zip(starts[one].tolist(), ends[one].tolist(), n.tolist(), strict=True):
        yield lowered[a:b], k


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of distinct (lang, word, n) and of their n-grams, with their numbers."""
    for batch in batches:
        by_lang: dict[str, list[int]] = {}
        for k, lang in enumerate(batch.column(0).to_pylist()):
            by_lang.setdefault(lang, []).append(k)
        words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
        for lang, rows in by_lang.items():
            waiting, held = [], 0
            for j, k in enumerate(rows):
                waiting.append(k)
                held += len(words[k])
                if held >= _SLICE or j == len(rows) - 1:
                    yield _table(lang, [words[i] for i in waiting], n[waiting])
                    waiting, held = [], 0


def _table(lang: str, words: list[str], weights: np.ndarray) -> pa.RecordBatch:
    points, starts, ends = _runs("\n".join(words))
    hashes = _word_hashes(points, starts, ends)
    kinds, found, counts = [np.zeros(len(hashes), np.int32)], [hashes], [weights]
    padded = _padded(points, starts, ends)
    for size in range(1, LONGEST + 1):
        grams, word = _gram_hashes(*padded, size)
        grams, at = np.unique(grams, return_inverse=True)
        kinds.append(np.full(len(grams), size, np.int32))
        found.append(grams)
        counts.append(np.bincount(at, weights=weights[word], minlength=len(grams)).astype(np.int64))
    kind = np.concatenate(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(kind), pa.string()), pa.array(kind), pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(counts))],
        names=["lang", "kind", "hash", "n"],
    )


class Model:
    """Per kind (0 words, else n-gram length) sorted hashes and their log frequencies by language."""

    def __init__(self, langs: list[str], kinds: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.langs, self.kinds = langs, kinds

    def rows(self, kind: int, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, or -1."""
        known = self.kinds[kind][0] if kind in self.kinds else np.zeros(0, np.uint64)
        if not len(known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, at, -1)

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log scores (texts x languages) and numbers of words that scored."""
        joined = "\n".join(texts)
        points, starts, ends = _runs(joined)
        # lower() can lengthen a text, so texts are found again by their separators' places
        bounds = np.concatenate([[0], np.cumsum([len(t.lower()) + 1 for t in texts])])
        doc = np.searchsorted(bounds, starts, "right") - 1
        hashes = _word_hashes(points, starts, ends)
        total = np.zeros((len(texts), len(self.langs)))
        used = np.zeros(len(texts))
        row = self.rows(0, hashes)
        hit = row >= 0
        if hit.any():
            self._add(total, doc[hit], self.kinds[0][1], row[hit], np.ones(int(hit.sum())))
            used += np.bincount(doc[hit], minlength=len(texts))
        rest = np.flatnonzero(~hit)
        for n in range(LONGEST, 0, -1):
            if not len(rest):
                break
            grams, word = _gram_hashes(*_padded(points, starts[rest], ends[rest]), n)
            row = self.rows(n, grams)
            found = (row >= 0) & (grams != _end_gram())  # a word's end alone is no evidence
            per = np.bincount(word[found], minlength=len(rest))
            if found.any():
                self._add(total, doc[rest][word[found]], self.kinds[n][1], row[found], 1.0 / per[word[found]])
                used += np.bincount(doc[rest[per > 0]], minlength=len(texts))
            rest = rest[per == 0]
        return total, used

    def likeness(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sum of each text's words' likeness to each language, its words, and those with anything known.

        A word's likeness is the mean log frequency of its n-grams, unknown ones counting as unseen,
        or its own log frequency if that is larger. Letters beside a digit, as in keys, are no word.
        """
        points, starts, ends = _runs("\n".join(texts))
        bounds = np.concatenate([[0], np.cumsum([len(t.lower()) + 1 for t in texts])])
        digit = np.zeros(len(points) + 2, bool)
        digit[1:-1] = (points >= 48) & (points <= 57)
        whole = ~(digit[starts] | digit[ends + 1])
        starts, ends = starts[whole], ends[whole]
        doc = np.searchsorted(bounds, starts, "right") - 1
        total, words = np.zeros((len(texts), len(self.langs))), np.bincount(doc, minlength=len(texts))
        grams, word = _gram_hashes(*_padded(points, starts, ends), LIKE)
        row, logs, unseen = self.rows(LIKE, grams), self.kinds[LIKE][1], self.unseen()
        per = np.maximum(1, np.bincount(word, minlength=len(starts)))
        known = self.rows(0, _word_hashes(points, starts, ends))
        hit = known >= 0
        for k in range(len(self.langs)):
            mean = np.bincount(word, weights=np.where(row >= 0, logs[row, k], unseen[k]), minlength=len(starts)) / per
            mean[hit] = np.maximum(mean[hit], self.kinds[0][1][known[hit], k])
            total[:, k] = np.bincount(doc, weights=mean, minlength=len(texts))
        seen = hit | (np.bincount(word[row >= 0], minlength=len(starts)) > 0)
        return total, words, np.bincount(doc[seen], minlength=len(texts))

    def unseen(self) -> np.ndarray:
        """By language, the log frequency of an n-gram that was not seen in it."""
        return self.kinds[LIKE][1].min(0)

    def _add(self, total: np.ndarray, doc: np.ndarray, logs: np.ndarray, row: np.ndarray, weight: np.ndarray) -> None:
        for k in range(len(self.langs)):
            total[:, k] += np.bincount(doc, weights=logs[row, k] * weight, minlength=len(total))


def _labelled(rows: DataFrame) -> tuple[list[str], DataFrame]:
    """The languages learned, and all rows labelled with one of them and with a text."""
    rows = rows.where("lang is not null and text is not null")
    commonest = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    langs = sorted(r[0] for r in commonest.collect())
    return langs, rows.where(F.col("lang").isin(langs))


def learn(labelled: DataFrame, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Fit on all of ``labelled`` (text, lang). Rows without lang or text teach nothing."""
    langs, chosen = _labelled(labelled.select("lang", "text"))
    if not langs:
        return Model([], {})
    distinct = chosen.mapInArrow(released(_counted), "lang string, word string, n long")
    distinct = distinct.groupBy("lang", "word").agg(F.sum("n").alias("n")).select("lang", "word", "n")
    counts = distinct.mapInArrow(released(_kinds), "lang string, kind int, hash long, n long")
    counts = counts.groupBy("lang", "kind", "hash").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "hash")
    rank = F.col("rank")
    kept = counts.withColumn("rank", F.row_number().over(top)).where(rank <= max(words, grams))  # cut before the shuffle too
    kept = kept.where(rank <= F.when(F.col("kind") == 0, words).otherwise(grams))
    found = kept.select("lang", "kind", "hash", "n").toPandas()  # bounded by languages x (words + 5 grams)
    kinds = {}
    for kind, part in found.groupby("kind"):
        hashes, row = np.unique(part["hash"].to_numpy().view(np.uint64), return_inverse=True)
        n = np.zeros((len(hashes), len(langs)))
        n[row, np.searchsorted(langs, part["lang"].to_numpy(object))] = part["n"].to_numpy()
        kinds[int(kind)] = hashes, np.log((n + 0.5) / (n.sum(0) + 0.5 * len(hashes)))
    return Model(langs, kinds)


def least_likeness(judged: DataFrame, model: Model, like: str) -> float:
    """The likeness below which a text is in no learned language, from the column ``like`` of all labelled rows."""
    _, rows = _labelled(judged.select("lang", "text", like))
    counts = rows.where(F.col(like).isNotNull()).groupBy(F.round(like, DIGITS).alias("like")).count()
    middle, low = counts.agg(F.percentile("like", 0.5, F.col("count")), F.percentile("like", 0.05, F.col("count"))).head()
    if middle is None:
        return -np.inf
    return max(middle - max(LEAST_GAP, SPREAD * (middle - low)), middle + WORST * (float(model.unseen().max()) - middle))


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Runs of pieces of the texts, about a slice together, with the text each belongs to."""
    at, waiting, held = [], [], 0
    for k, text in enumerate(texts):
        for piece in _cut(text or ""):
            at.append(k)
            waiting.append(piece)
            held += len(piece)
            if held >= _SLICE:
                yield np.array(at), waiting
                at, waiting, held = [], [], 0
    if waiting:
        yield np.array(at), waiting


def _scores(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The language and score of each text."""
    total, used = np.zeros((len(texts), max(1, len(model.langs)))), np.zeros(len(texts))
    letters = np.array([any(map(str.isalpha, t or "")) for t in texts], bool)
    if model.langs:
        for at, pieces in _pieces(texts):
            more, n = model.sums(pieces)
            np.add.at(total, at, more)
            np.add.at(used, at, n)
    known = letters & bool(model.langs)
    scaled = total * np.minimum(1.0, EVIDENCE / np.maximum(used, 1))[:, None]
    scaled = np.exp(scaled - scaled.max(1, keepdims=True))
    score = np.where(known, scaled.max(1) / scaled.sum(1), 0.0)
    return [model.langs[b] if ok else UNKNOWN for b, ok in zip(scaled.argmax(1), known, strict=True)], score


def _likeness(model: Model, texts: list[str | None]) -> list[float | None]:
    """The likeness of each text, a mean per word, to the learned language it is most like.

    None for a text without a word, or without a word of which anything is known.
    """
    total, words, seen = np.zeros((len(texts), max(1, len(model.langs)))), np.zeros(len(texts)), np.zeros(len(texts))
    if LIKE in model.kinds:
        for at, pieces in _pieces(texts):
            more, n, m = model.likeness(pieces)
            np.add.at(total, at, more)
            np.add.at(words, at, n)
            np.add.at(seen, at, m)
    return [t / n if m else None for t, n, m in zip(total.max(1).tolist(), words.tolist(), seen.tolist(), strict=True)]


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row's whole text.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text if nothing
    was learned. One with letters but without a known word or n-gram gets the language first in order,
    with the same share for each language as score; so do ties. Other columns are ignored; repeated
    rows are judged alike; an empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                pred, score = _scores(shared.value, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    rows = documents.select("doc_id", "text")
    schema = StructType([rows.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(released(run), schema)


def judged(documents: DataFrame, model: Model, like: str, pred: str | None = None) -> DataFrame:
    """``documents`` with the likeness of each row's text, a mean per word, in the further column ``like``.

    It is null for texts without a word apart from digits, or without a word of which itself or any
    trigram is known. With ``pred``, that column has the language which ``predict`` finds for the text.
    Rows pass as they came.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")
    fields = [*([StructField(pred, StringType())] if pred else []), StructField(like, DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                texts = part.column(at).to_pylist()
                found = [pa.array(_scores(shared.value, texts)[0], pa.string())] if pred else []
                found.append(pa.array(_likeness(shared.value, texts), pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=[*part.schema.names, *[f.name for f in fields]])

    return documents.mapInArrow(released(run), StructType([*documents.schema.fields, *fields]))


def remainder(doc_id: str, of: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of
