"""Language identification: script ranges, word scores and Viterbi spans.

A word is a run of letters.  The script range of its first letter narrows the
languages to those that were seen to use it; character n-grams, hashed, score the word
in each of them.  Viterbi decoding with a penalty for each switch labels the words, so
a text in several languages falls into spans.  A document's language is the one with
most letters, and its score is that share of the letters.

The model learns from a bounded sample of the labelled documents of each language
(``Settings``), so every labelled language can be predicted; every word of every
document is scored.

Defined cases: a null text or one without letters is ``und`` with score 0; so is every
text if nothing is learnt; a script no language was seen in leaves all languages open;
equal totals go to the first language by name; null languages and ids are not learnt
from; repeated rows get equal results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import fold, text_chunks, texts

UNKNOWN = "und"
FOLDS, HELD_OUT = 5, 0
WORD = re.compile(r"[^\W\d_]+")
BATCH_CHARS = 8_000_000
#: First code points of script ranges (Unicode blocks), each up to the next.
SCRIPT_STARTS = np.array(
    [0, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0780, 0x0900, 0x0980, 0x0A00, 0x0A80, 0x0B00,
     0x0B80, 0x0C00, 0x0C80, 0x0D00, 0x0D80, 0x0E00, 0x0E80, 0x0F00, 0x1000, 0x10A0, 0x1100,
     0x1200, 0x1380, 0x1780, 0x1800, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0, 0x3100, 0x3400,
     0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00]
)


def words_of(text: str) -> list[str]:
    """Lower-case words of letters alone."""
    words = WORD.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    # Numerals that are no decimal digits are word characters, but no letters.
    return [
        part
        for word in words
        for part in "".join(c if c.isalpha() else " " for c in word).split()
    ]


@dataclass(frozen=True)
class Settings:
    """Bounds of the labelled sample and parameters of the scores."""

    #: Of each language.
    sample_rows: int = 5000
    buckets: int = 1 << 16
    orders: tuple[int, ...] = (1, 2, 3, 4)
    smoothing: float = 0.5
    switch: float = 12.0
    #: A language uses a script if so many of its sampled words do.
    script_share: float = 0.01
    kept_words: int = 300_000


@dataclass
class Model:
    settings: Settings
    languages: list[str]
    table: np.ndarray
    scripts: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods, one row per word, narrowed by the words' scripts."""
        hashes, owner = _grams(words, self.settings)
        order = np.argsort(owner, kind="stable")
        starts = np.searchsorted(owner[order], np.arange(len(words)))
        scores = np.add.reduceat(self.table[hashes[order]], starts, axis=0)
        first = np.array([ord(word[0]) for word in words])
        allowed = self.scripts[np.searchsorted(SCRIPT_STARTS, first, side="right") - 1]
        return np.where(allowed, scores, scores.min(axis=1, keepdims=True) - 20).astype(np.float32)


def _grams(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the words between marks, and each one's word."""
    line = "\0" + "\0".join(words) + "\0"
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.cumsum(codes == 0) - 1
    marks = np.cumsum(np.append(0, codes == 0))
    hashes, owner = [], []
    for order in settings.orders:
        count = len(codes) - order + 1
        value = np.full(count, order, np.uint64)
        for k in range(order):
            value = (value ^ codes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        inner = marks[order - 1 : order - 1 + count] - marks[1 : count + 1] if order > 1 else 0
        own = (inner <= 0) & (word[:count] < len(words))
        if order == 1:
            own &= codes != 0
        hashes.append((value[own] % settings.buckets).astype(np.int64))
        owner.append(word[:count][own])
    return np.concatenate(hashes), np.concatenate(owner)


def train(rows: Iterable, settings: Settings = Settings()) -> Model:
    """A model from (text, lang) rows, which are read one by one."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for row in rows:
        if row.lang not in held:
            held[row.lang] = np.zeros(settings.buckets), np.zeros(len(SCRIPT_STARTS))
        words = words_of(row.text)
        if words:
            hashes, _ = _grams(words, settings)
            first = np.array([ord(word[0]) for word in words])
            place = np.searchsorted(SCRIPT_STARTS, first, side="right") - 1
            for total, found in zip(held[row.lang], (hashes, place), strict=True):
                total += np.bincount(found, minlength=len(total))
    names = sorted(held)
    counts = np.full((settings.buckets, max(1, len(names))), settings.smoothing)
    scripts = np.zeros((len(SCRIPT_STARTS), max(1, len(names))))
    for k, name in enumerate(names):
        counts[:, k] += held[name][0]
        scripts[:, k] += held[name][1]
    used = scripts >= settings.script_share * np.maximum(scripts.sum(axis=0), 1)
    used[~used.any(axis=1)] = True
    return Model(settings, names, np.log(counts / counts.sum(axis=0)).astype(np.float32), used)


def fitted(
    docs: DataFrame,
    settings: Settings = Settings(),
    exclude: tuple[int, int] | None = (FOLDS, HELD_OUT),
) -> Model:
    """A model of the sampled labelled documents; exclude: an id fold never learnt from."""
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    ).filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    if exclude:
        known = known.filter(fold("doc_id", exclude[0]) != exclude[1])
    sample = known.join(_chosen(known, settings.sample_rows), ["doc_id", "lang"])
    return train(sample.select("text", "lang").toLocalIterator(), settings)


def _chosen(known: DataFrame, rows: int) -> DataFrame:
    """The ids of each language with the least hashes, so many of each at most.

    A bar at twice that share of the hashes leaves few rows to be ranked.
    """
    ids = known.select("lang", "doc_id").distinct().withColumn("hash", F.xxhash64("doc_id"))
    sizes = ids.groupBy("lang").agg(F.count("*").alias("ids"))
    few = ids.join(sizes, "lang").filter((F.col("hash") / 2.0**64 + 0.5) * F.col("ids") <= 2 * rows + 100)
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    ranked = few.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= rows).select("doc_id", "lang")


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best language number of each word; documents follow one another in scores."""
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, longest = starts[order], int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    came = np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    state = np.zeros((len(lengths), scores.shape[1]), np.float32)
    for t in range(longest):
        n = active[t]
        here, at = state[:n], begin[:n] + t
        if t:
            top = here.argmax(axis=1)
            leap = here[np.arange(n), top][:, None] - switch
            moved = leap > here
            came[at] = np.where(moved, top[:, None].astype(np.int16), own)
            here = np.maximum(here, leap)
        state[:n] = here + scores[at]
    best = np.zeros(len(scores), np.int16)
    label = state.argmax(axis=1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        best[at] = label[:n]
        label[:n] = came[at, label[:n]]
    return best


class Labeller:
    """Labels texts; the scores of word forms are kept within a task."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[str, int] = {}
        self.scores = np.empty((0, len(self.model.languages)), np.float32)

    def label(self, held: list[str]) -> list[tuple[str, float, list]]:
        """Per text: language, score and spans (first word, words, language)."""
        languages, numbers = self.model.languages, self.numbers
        if not languages:
            return [(UNKNOWN, 0.0, []) for _ in held]
        if len(numbers) > self.model.settings.kept_words:
            self.reset()
            numbers = self.numbers
        lines, letters, new = [], [], []
        for text in held:
            words = words_of(text)
            for word in set(words).difference(numbers):
                numbers[word] = len(numbers)
                new.append(word)
            lines.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            letters.append(np.fromiter(map(len, words), np.int64, len(words)))
        if new:
            self.scores = np.concatenate((self.scores, self.model.word_scores(new)))
        lengths = np.array([len(line) for line in lines], np.int64)
        words = np.concatenate(lines) if lines else np.empty(0, np.int32)
        path = viterbi(self.scores[words], lengths, self.model.settings.switch)
        results, at = [], 0
        for line, sizes in zip(lines, letters, strict=True):
            own = path[at : at + len(line)]
            at += len(line)
            if not len(line):
                results.append((UNKNOWN, 0.0, []))
                continue
            totals = np.bincount(own, weights=sizes, minlength=len(languages))
            best = int(totals.argmax())
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1, [len(own)])).tolist()
            spans = [(a, b - a, languages[own[a]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            results.append((languages[best], float(totals[best] / totals.sum()), spans))
        return results


def _label_batches(model: Model):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        kind = pa.list_(
            pa.struct([("first_word", pa.int64()), ("words", pa.int64()), ("lang", pa.string())])
        )
        for batch, held in text_chunks(batches, BATCH_CHARS):
            found = labeller.label(held)
            spans = [
                [dict(zip(("first_word", "words", "lang"), span, strict=True)) for span in spans]
                for _, _, spans in found
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([lang for lang, _, _ in found], pa.string()),
                    pa.array([score for _, score, _ in found], pa.float64()),
                    pa.array(spans, kind),
                ],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    return label


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and spans of every document."""
    schema = (
        "doc_id long, lang_pred string, score double,"
        " spans array<struct<first_word: long, words: long, lang: string>>"
    )
    labelled = texts(docs).mapInArrow(_label_batches(model), schema)
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return labelled.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "spans")
