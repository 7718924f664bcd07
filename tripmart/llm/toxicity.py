"""Toxicity scores from a convolutional text classifier trained in numpy.

Words are hashed twice into two small embedding tables, so that two words are
confused only if both hashes agree.  Filters of several widths slide over the whole
text, the maximum of each filter over the text is kept, and a linear layer gives a
logit.  Thresholds are calibrated by language, which is guessed from the text's own
words; a score of 0.3 is the calibrated threshold in every language.

Training reads a bounded sample of labelled rows (``Settings``), the scores cover
whole texts of all documents.

Defined cases: a null or empty text, and one without words, gets the score of the
bare bias; a null label or id is not learnt from; repeated labels of a document
count once, toxic if any says so; without labels of both kinds every score is the
share of toxic labels (0 without labels); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fold, text_chunks, texts

CUT = 0.3
FOLDS, HELD_OUT = 4, 2


@dataclass(frozen=True)
class Settings:
    """Sizes of the model and bounds of the labelled sample."""

    buckets: int = 1 << 16
    half: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 6
    #: Small samples are gone through more often, up to so many steps.
    least_steps: int = 600
    batch: int = 16
    toxic_rows: int = 1500
    clean_rows: int = 3000
    #: Longer labelled texts are left out of the sample (never of the scores).
    sample_chars: int = 40_000
    seed: int = 7


class Buckets(dict):
    """Words to 32-bit hashes; word forms are kept until there are too many."""

    def __missing__(self, word: str) -> int:
        core = word.strip(_EDGES)
        value = zlib.crc32(core.encode("utf-8", "surrogatepass")) if core else 0
        self[word] = value
        return value

    def of(self, text: str) -> np.ndarray:
        if len(self) > 300_000:
            self.clear()
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


_EDGES = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum()) + "«»“”„’‘…¡¿–—"


@dataclass
class Model:
    """Tables and filters; a language's offset is added to the logit."""

    settings: Settings
    first: np.ndarray
    second: np.ndarray
    filters: list[np.ndarray]
    filter_bias: np.ndarray
    out: np.ndarray
    bias: float
    languages: list[str]
    language_words: np.ndarray
    offsets: np.ndarray

    def embed(self, hashes: np.ndarray) -> np.ndarray:
        mask = self.settings.buckets - 1
        rows = np.concatenate(
            [self.first[hashes & mask], self.second[(hashes >> 16) & mask]], axis=1
        )
        rows[hashes == 0] = 0
        return rows

    def convolve(self, rows: np.ndarray) -> np.ndarray:
        """Filter outputs at each position; rows past the end count as zero."""
        outputs = []
        for width, filters in zip(self.settings.widths, self.filters, strict=True):
            parts = rows @ filters
            total = parts[:, : self.settings.filters].copy()
            for k in range(1, width):
                total[:-k] += parts[k:, k * self.settings.filters : (k + 1) * self.settings.filters]
            outputs.append(total)
        return np.concatenate(outputs, axis=1) + self.filter_bias

    def pooled(self, documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Per document the maxima of its filters, and its words' language scores."""
        gap = np.zeros(max(self.settings.widths), np.uint32)
        pieces = [part for document in documents for part in (document, gap)]
        hashes = np.concatenate(pieces)
        starts = np.cumsum([0, *[len(d) + len(gap) for d in documents]])[:-1]
        outputs = np.maximum(self.convolve(self.embed(hashes)), 0)
        spoken = self.language_words[hashes & (len(self.language_words) - 1)]
        spoken[hashes == 0] = 0
        return np.maximum.reduceat(outputs, starts), np.add.reduceat(spoken, starts)

    def logits(self, documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Uncalibrated logits and the guessed language's number."""
        maxima, spoken = self.pooled(documents)
        return maxima @ self.out + self.bias, spoken.argmax(axis=1)

    def scores(self, documents: list[np.ndarray]) -> np.ndarray:
        logits, language = self.logits(documents)
        return 1 / (1 + np.exp(-np.clip(logits + self.offsets[language], -50, 50)))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, settings: Settings, exclude: tuple[int, int] | None
) -> list:
    """Rows (text, lang, toxic) of the sampled labels, least hashes first.

    exclude: (parts, remainder) of the id fold that is never learnt from.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic")
    ).filter("label_id IS NOT NULL AND toxic IS NOT NULL")
    if exclude:
        known = known.filter(fold("label_id", exclude[0]) != exclude[1])
    known = known.groupBy("label_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    order = [F.xxhash64("label_id"), F.col("label_id")]
    chosen = (
        known.filter("toxic = 1").orderBy(*order).limit(settings.toxic_rows)
        .unionByName(known.filter("toxic = 0").orderBy(*order).limit(settings.clean_rows))
    )
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    sample = docs.select(
        F.col("doc_id").cast("long").alias("label_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(lang, F.lit("")).alias("lang"),
    ).filter(F.length("text") <= settings.sample_chars)
    rows = sample.join(F.broadcast(chosen), "label_id").select("label_id", "text", "lang", "toxic")
    return sorted(rows.collect(), key=lambda row: (zlib.crc32(str(row.label_id).encode()), row.text))


def _shrunken_odds(documents, labels, buckets, shift):
    """Per bucket the log-odds of its documents' labels, pulled to zero if rare."""
    counts = np.zeros((2, buckets), np.float32)
    for words, label in zip(documents, labels, strict=True):
        seen = np.unique((words[words != 0] >> shift) & (buckets - 1))
        counts[int(label), seen] += 1
    share = counts.sum(axis=0)
    totals = np.array([max(1, (labels == k).sum()) for k in (0, 1)], np.float32)
    odds = np.log((counts[1] + 0.5) / (totals[1] + 1)) - np.log((counts[0] + 0.5) / (totals[0] + 1))
    return odds * share / (share + 5) * (share >= 2)


def _language_tables(documents, langs, settings):
    """Hashed unigram log-probabilities of each language of the sample."""
    names = sorted({lang for lang in langs if lang}) or [""]
    counts = np.full((settings.buckets, len(names)), 0.1, np.float64)
    for words, lang in zip(documents, langs, strict=True):
        if lang in names:
            np.add.at(counts[:, names.index(lang)], words[words != 0] & (settings.buckets - 1), 1)
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def train(rows: list, settings: Settings = Settings()) -> Model:
    """A model fitted to (text, lang, toxic) rows; every fifth one calibrates it."""
    rng = np.random.default_rng(settings.seed)
    buckets = Buckets()
    documents = [buckets.of(row.text) for row in rows]
    labels = np.array([row.toxic for row in rows], np.float32)
    width = len(settings.widths) * settings.filters
    names, language_words = _language_tables(documents, [row.lang for row in rows], settings)
    model = Model(
        settings,
        *[rng.normal(0, 0.01, (settings.buckets, settings.half)).astype(np.float32) for _ in "ab"],
        [
            rng.normal(0, 0.3, (2 * settings.half, k * settings.filters)).astype(np.float32)
            for k in settings.widths
        ],
        np.zeros(width, np.float32),
        rng.normal(0.3, 0.1, width).astype(np.float32),
        0.0,
        names,
        language_words,
        np.zeros(len(names), np.float32),
    )
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        model.out[:] = 0
        model.bias = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return model
    fit = [i for i in range(len(rows)) if i % 5]
    model.first[:, 0] = _shrunken_odds([documents[i] for i in fit], labels[fit], settings.buckets, 0)
    model.second[:, 0] = _shrunken_odds([documents[i] for i in fit], labels[fit], settings.buckets, 16)
    _fit(model, documents, labels, fit, rng)
    _calibrate(model, documents, labels, [row.lang for row in rows])
    return model


def _fit(model: Model, documents, labels, fit, rng) -> None:
    """Adam on the logistic loss; gradients reach the words that won a maximum."""
    settings = model.settings
    dense = [*model.filters, model.filter_bias, model.out, np.zeros(1, np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in dense]
    gap = np.zeros(max(settings.widths), np.uint32)
    mask, step = settings.buckets - 1, 0
    per_epoch = -(-len(fit) // settings.batch)
    for _ in range(max(settings.epochs, -(-settings.least_steps // per_epoch))):
        order = rng.permutation(fit)
        for at in range(0, len(order), settings.batch):
            batch = order[at : at + settings.batch]
            pieces = [part for i in batch for part in (documents[i], gap)]
            hashes = np.concatenate(pieces)
            bounds = np.cumsum([0, *[len(documents[i]) + len(gap) for i in batch]])
            rows = model.embed(hashes)
            outputs = model.convolve(rows)
            winners = np.stack(
                [outputs[a:b].argmax(axis=0) + a for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            )
            maxima = np.take_along_axis(outputs, winners, axis=0)
            active = np.maximum(maxima, 0)
            logits = active @ model.out + dense[-1][0]
            error = (1 / (1 + np.exp(-logits)) - labels[batch]) / len(batch)
            back = error[:, None] * model.out[None, :] * (maxima > 0)
            grads = [np.zeros_like(p) for p in dense]
            grads[-3][:] = back.sum(axis=0)
            grads[-2][:] = active.T @ error + 1e-4 * model.out
            grads[-1][0] = error.sum()
            embed_grad: dict[int, np.ndarray] = {}
            for w, width in enumerate(settings.widths):
                own = slice(w * settings.filters, (w + 1) * settings.filters)
                for k in range(width):
                    at_word = np.minimum(winners[:, own] + k, len(hashes) - 1)
                    columns = slice(k * settings.filters, (k + 1) * settings.filters)
                    grads[w][:, columns] += np.einsum("df,dfe->ef", back[:, own], rows[at_word])
                    moved = back[:, own, None] * model.filters[w][:, columns].T[None]
                    for place, grad in zip(at_word.ravel(), moved.reshape(-1, 2 * settings.half), strict=True):
                        embed_grad[place] = embed_grad.get(place, 0) + grad
            step += 1
            for p, g, (mean, square) in zip(dense, grads, moments, strict=True):
                mean += 0.1 * (g - mean)
                square += 0.001 * (g * g - square)
                p -= 0.01 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            for place, grad in embed_grad.items():
                if word := int(hashes[place]):
                    model.first[word & mask] -= 0.5 * grad[: settings.half]
                    model.second[(word >> 16) & mask] -= 0.5 * grad[settings.half :]
    model.bias = float(dense[-1][0])


def _best_threshold(logits: np.ndarray, labels: np.ndarray, slack: float = 0.01) -> float:
    """The middle of the widest gap among the cuts whose F1 is within slack of the best."""
    order = np.argsort(-logits, kind="stable")
    ranked = logits[order]
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    gaps = ranked - np.append(ranked[1:], ranked[-1] - 0.1)
    best = int(np.where(f1 >= f1.max() - slack, gaps, -1).argmax())
    return float(ranked[best] - gaps[best] / 2)


def _calibrate(model: Model, documents, labels, langs) -> None:
    """Offsets that put each language's threshold at a score of CUT.

    Rows that were not fitted to decide where a language has both labels among
    them; a language with fewer than 20 of them takes the common threshold.
    """
    held = [i for i in range(len(documents)) if i % 5 == 0]
    logits, guessed = [], []
    for at in range(0, len(held), 64):
        a, b = model.logits([documents[i] for i in held[at : at + 64]])
        logits.append(a)
        guessed.append(b)
    logits, guessed = np.concatenate(logits), np.concatenate(guessed)
    target = labels[held]
    common = _best_threshold(logits, target) if target.any() else 0.0
    base = np.log(CUT / (1 - CUT))
    for k in range(len(model.languages)):
        own = guessed == k
        enough = own.sum() >= 20 and 5 <= target[own].sum() < own.sum()
        model.offsets[k] = base - (_best_threshold(logits[own], target[own]) if enough else common)


def _score_batches(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch, held in text_chunks(batches):
            scores = model.scores([buckets.of(text) for text in held])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores.astype(np.float64))], names=["doc_id", "score"]
            )

    return score


def _clean_batches(model: Model):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch, held in text_chunks(batches):
            scores = model.scores([buckets.of(text) for text in held])
            yield batch.filter(pa.array(scores < CUT))

    return clean


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    exclude: tuple[int, int] | None = (FOLDS, HELD_OUT),
) -> Model:
    return train(labelled_sample(docs, labels, settings, exclude), settings)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = texts(docs).mapInArrow(_score_batches(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents scored below CUT, with all their columns."""
    return docs.mapInArrow(_clean_batches(model), docs.schema)
