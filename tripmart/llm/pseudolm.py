"""Documents scored by masked pseudo-likelihood of a bidirectional window network.

Each token (a word or a sign) is hidden in turn and predicted from the tokens on both
sides: tables of the neighbours' vectors, one for each place, are added, a tanh layer
follows, and a two-level softmax gives first the token's class and then the token within
it.  A document's score is the sum of the log-probabilities of all its tokens.

The most frequent words of all documents have entries of their own.  Any other word is
predicted as "another word" by the network and then letter by letter, to its end, by a
model of the bytes of all such words of the corpus, so that no two words are the same to
the score.  As neighbours, other words share hashed entries.

Documents are encoded once, to a stored table of numbers.  They are dealt to shards by
a hash of id and content; the number of shards follows the tokens, the rows of a shard are
sorted, and every shard trains the network in numpy with one pass over all its
documents.  Parameters are averaged as fixed-point numbers in Spark, slice by slice.  So
the network depends neither on partitions nor on the order of sums; scores differ between
layouts by the rounding of 32-bit products alone.  Work, counts and shards grow with the
corpus; what is broadcast (network, words, bytes) has a fixed size.

Defined cases: a null or empty text, and one of white space alone, has no tokens and score
0 (its mean is null); places beyond the text's ends read a mark of their own; repeated rows
get equal scores, and train apart if their ids differ (rows equal in id and text share a
shard); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored, text_chunks, texts

WORD = re.compile(r"\w+|[^\w\s]")


@dataclass(frozen=True)
class Settings:
    classes: int = 32
    per_class: int = 32
    #: Entries that words outside the vocabulary share as neighbours; the first stands
    #: for all of them where they are predicted.
    shared: int = 64
    reach: int = 2
    hidden: int = 16
    step: float = 0.2
    batch: int = 16_384
    #: Tokens of a shard; their number over the corpus gives the number of shards.
    shard_tokens: int = 8_000_000
    seed: int = 5
    counted_words: int = 200_000

    @property
    def size(self) -> int:
        return self.classes * self.per_class

    @property
    def other(self) -> int:
        """The entry of words outside the vocabulary, and the first of their shared ones."""
        return self.size - self.shared

    @property
    def places(self) -> list[int]:
        return [k for k in range(-self.reach, self.reach + 1) if k]


SLICE = 64
#: Parameters are summed as whole multiples of this.
UNIT = 2.0**-32
#: Tokens that a task trains on or scores at once.
HELD_TOKENS = 262_144

#: Bytes that UTF-8 never has: before a word and at its end.
START, END = 0xFF, 0xFE
CONTEXTS = 4096
SMOOTHING = 4.0


def _count_batches(settings: Settings):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_pydict(
                {"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())}
            )
            held.clear()
            return batch

        for _, chunk in text_chunks(batches):
            for text in chunk:
                held.update(WORD.findall(text.lower()))
            if len(held) > settings.counted_words:
                yield flush()
        yield flush()

    return count


def word_counts(docs: DataFrame, settings: Settings) -> DataFrame:
    """word and n of every word of the documents, stored."""
    counts = (
        texts(docs)
        .select("text")
        .mapInArrow(_count_batches(settings), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    return stored(counts, "words")


def vocabulary(counts: DataFrame, settings: Settings) -> list[str]:
    """The most frequent words of all documents, by count and then by text."""
    top = counts.orderBy(F.desc("n"), "word").limit(settings.other)
    return [row.word for row in top.collect()]


def _context(before: int, last: int) -> int:
    return (before * 59 + last) % CONTEXTS


def _spelling_batches(words: list[str]):
    known = set(words)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CONTEXTS * 256, np.int64)
        for batch in batches:
            rare = [
                (word.encode("utf-8", "surrogatepass"), n)
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                if word not in known
            ]
            if not rare:
                continue
            line = np.frombuffer(b"".join(b"\xff\xff" + word + b"\xfe" for word, _ in rare), np.uint8)
            line = line.astype(np.int64)
            weight = np.repeat([n for _, n in rare], [len(word) + 3 for word, _ in rare])
            at = np.flatnonzero(line != START)
            code = _context(line[at - 2], line[at - 1]) * 256 + line[at]
            np.add.at(total, code, weight[at])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"code": pa.array(used), "n": pa.array(total[used])})

    return spell


def spelling(counts: DataFrame, words: list[str]) -> np.ndarray:
    """Log-probability of each byte after a context, from all words outside the vocabulary.

    At most CONTEXTS * 256 numbers, whatever the corpus.
    """
    summed = counts.select("word", "n").mapInArrow(_spelling_batches(words), "code long, n long")
    rows = summed.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(CONTEXTS * 256)
    table[rows["code"].to_numpy()] = rows["n"].to_numpy()
    table = table.reshape(CONTEXTS, 256)
    alone = (table.sum(axis=0) + 1) / (table.sum() + 256)
    share = (table + SMOOTHING * alone) / (table.sum(axis=1, keepdims=True) + SMOOTHING)
    return np.log(share).astype(np.float32).ravel()


class Numbers(dict):
    """Words to vocabulary numbers; other words to places in a list of their own."""

    def __init__(self, words: list[str], settings: Settings, letters: np.ndarray) -> None:
        super().__init__((word, n) for n, word in enumerate(words))
        self.words, self.settings, self.letters = words, settings, letters
        #: Of each other word met: its shared entry, the score of its letters, those to score.
        self.shared: list[int] = []
        self.spelt: list[float] = []
        self.unspelt: list[str] = []

    def spell(self, words: list[str]) -> list[float]:
        """Log-probabilities of the words' bytes and their ends."""
        line = np.frombuffer("".join(words).encode("utf-8", "surrogatepass"), np.uint8)
        sizes = [len(word.encode("utf-8", "surrogatepass")) + 3 for word in words]
        ends = np.cumsum(sizes)
        padded = np.full(ends[-1], START)
        padded[ends - 1] = END
        inside = np.ones(len(padded), bool)
        inside[ends - 1] = inside[ends - np.array(sizes)] = inside[ends - np.array(sizes) + 1] = False
        padded[inside] = line
        cost = np.zeros(len(padded))
        at = np.flatnonzero(padded != START)
        cost[at] = self.letters[_context(padded[at - 2], padded[at - 1]) * 256 + padded[at]]
        return np.add.reduceat(cost, ends - np.array(sizes)).tolist()

    def __missing__(self, word: str) -> int:
        settings = self.settings
        code = zlib.crc32(word.encode("utf-8", "surrogatepass")) % settings.shared
        value = self[word] = settings.size + len(self.shared)
        self.shared.append(settings.other + code)
        self.unspelt.append(word)
        return value

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], list[float]]:
        """Each text's numbers, and the log-probability of the letters of its other words."""
        if len(self.shared) > 400_000:
            self.clear()
            self.update((word, n) for n, word in enumerate(self.words))
            self.shared, self.spelt = [], []
        size = self.settings.size
        lines = []
        for text in texts:
            words = WORD.findall(text.lower())
            lines.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        if self.unspelt:
            self.spelt += self.spell(self.unspelt)
            self.unspelt = []
        shared, spelt = np.array(self.shared, np.int64), np.array(self.spelt)
        sums = []
        for line in lines:
            at = np.flatnonzero(line >= size)
            other = line[at] - size
            line[at] = shared[other]
            sums.append(float(spelt[other].sum()))
        return lines, sums


def _encode_batches(words: list[str], settings: Settings, letters: np.ndarray):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(words, settings, letters)
        for batch, held in text_chunks(batches):
            lines, spelt = numbers.of(held)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(list(map(len, lines)), pa.int64()),
                    pa.array([line.astype("<u2").tobytes() for line in lines], pa.binary()),
                    pa.array(spelt, pa.float64()),
                ],
                names=["doc_id", "n_tokens", "numbers", "spelt"],
            )

    return encode


def encoded(docs: DataFrame, words: list[str], settings: Settings, letters: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, numbers (16 bits each) and the letters' score of every document, stored."""
    table = texts(docs).mapInArrow(
        _encode_batches(words, settings, letters),
        "doc_id long, n_tokens long, numbers binary, spelt double",
    )
    return stored(table, "encoded")


@dataclass
class Network:
    settings: Settings
    near: np.ndarray  # places x (size + 1) x hidden; the last entry is beyond the text
    bias: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray  # classes x hidden x per_class
    word_bias: np.ndarray

    def __post_init__(self) -> None:
        self.squares = [np.full_like(part, 1e-6) for part in self.parts]

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.near, self.bias, self.to_class, self.class_bias, self.to_word, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self.parts])

    def fill(self, values: np.ndarray) -> None:
        at = 0
        for part in self.parts:
            part[...] = values[at : at + part.size].reshape(part.shape)
            at += part.size

    def windows(self, lines: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens as predicted, and for each the numbers at its neighbouring places."""
        reach, mark = self.settings.reach, self.settings.size
        gap = np.full(reach, mark)
        padded = np.concatenate([gap, *[part for line in lines for part in (line, gap)]]).astype(np.int16)
        own = np.flatnonzero(padded != mark)
        around = np.stack([padded[own + k] for k in self.settings.places])
        return np.minimum(padded[own], self.settings.other), around

    def hidden(self, around: np.ndarray) -> np.ndarray:
        total = self.near[0].take(around[0], axis=0)
        total += self.bias
        for table, numbers in zip(self.near[1:], around[1:], strict=True):
            total += table.take(numbers, axis=0)
        return np.tanh(total, out=total)

    def _by_class(self, tokens: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The order by class, and (class, first, last) of each class that occurs."""
        own = tokens // self.settings.per_class
        order = np.argsort(own, kind="stable")
        bounds = np.searchsorted(own[order], np.arange(self.settings.classes + 1)).tolist()
        runs = [(k, a, b) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
        return order, runs

    def log_probabilities(self, tokens: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Of each token given its neighbours."""
        result = np.empty(len(tokens), np.float32)
        for at in range(0, len(tokens), self.settings.batch):
            part = slice(at, at + self.settings.batch)
            result[part] = self._log_probabilities(tokens[part], around[:, part])
        return result

    def _log_probabilities(self, tokens: np.ndarray, around: np.ndarray) -> np.ndarray:
        order, runs = self._by_class(tokens)
        tokens = tokens[order]
        own, within = np.divmod(tokens, self.settings.per_class)
        hidden = self.hidden(around[:, order])
        share = _log_share(_logits(hidden, self.to_class, self.class_bias), own)
        for k, a, b in runs:
            logits = _logits(hidden[a:b], self.to_word[k], self.word_bias[k])
            share[a:b] += _log_share(logits, within[a:b])
        result = np.empty_like(share)
        result[order] = share
        return result

    def learn(self, tokens: np.ndarray, around: np.ndarray) -> None:
        """One step of gradient descent on a batch, each parameter at its own pace."""
        settings, count = self.settings, np.float32(1 / len(tokens))
        near2, bias2, to_class2, class_bias2, to_word2, word_bias2 = self.squares
        order, runs = self._by_class(tokens)
        tokens, around = tokens[order], around[:, order]
        own, within = np.divmod(tokens, settings.per_class)
        hidden = self.hidden(around)
        error = _softmax_error(_logits(hidden, self.to_class, self.class_bias), own, count)
        back = error @ self.to_class.T
        self._step(self.to_class, to_class2, hidden.T @ error)
        self._step(self.class_bias, class_bias2, error.sum(axis=0))
        word_slope, word_bias_slope = np.zeros_like(self.to_word), np.zeros_like(self.word_bias)
        for k, a, b in runs:
            error = _softmax_error(_logits(hidden[a:b], self.to_word[k], self.word_bias[k]), within[a:b], count)
            back[a:b] += error @ self.to_word[k].T
            np.matmul(hidden[a:b].T, error, out=word_slope[k])
            np.sum(error, axis=0, out=word_bias_slope[k])
        self._step(self.to_word, to_word2, word_slope)
        self._step(self.word_bias, word_bias2, word_bias_slope)
        back *= 1 - hidden * hidden
        self._step(self.bias, bias2, back.sum(axis=0))
        for table, squares, numbers in zip(self.near, near2, around, strict=True):
            by_number = np.argsort(numbers, kind="stable")
            ranked = numbers[by_number]
            first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            rows = ranked[first]
            slope = np.add.reduceat(back[by_number], first, axis=0)
            total = squares[rows] + slope * slope
            squares[rows] = total
            table[rows] -= settings.step * slope / np.sqrt(total)

    def _step(self, part: np.ndarray, squares: np.ndarray, slope: np.ndarray) -> None:
        squares += slope * slope
        part -= self.settings.step * slope / np.sqrt(squares)


def _logits(hidden: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    logits = hidden @ weights
    logits += bias
    return logits


def _lowered(logits: np.ndarray) -> np.ndarray:
    """In place: each row less a number that keeps its sum of exponents in range.

    The highest logit of all rows will do for most; rows far below it take their own.
    """
    logits -= logits.max()
    low = np.flatnonzero(logits[:, 0] < -30)
    if len(low):
        logits[low] -= logits[low].max(axis=1, keepdims=True)
    return logits


def _row_sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], np.float32)  # faster than sum over a short axis


def _log_share(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    own = _lowered(logits)[np.arange(len(logits)), chosen]
    return own - np.log(_row_sums(np.exp(logits, out=logits)))


def _softmax_error(logits: np.ndarray, chosen: np.ndarray, scale: np.float32) -> np.ndarray:
    """Shares less one at the chosen entry, times the scale."""
    np.exp(_lowered(logits), out=logits)
    logits *= (scale / _row_sums(logits))[:, None]
    logits[np.arange(len(logits)), chosen] -= scale
    return logits


def new_network(settings: Settings) -> Network:
    rng = np.random.default_rng(settings.seed)

    def normal(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.1, shape).astype(np.float32)

    h = settings.hidden
    return Network(
        settings,
        normal(2 * settings.reach, settings.size + 1, h),
        np.zeros(h, np.float32),
        normal(h, settings.classes),
        np.zeros(settings.classes, np.float32),
        normal(settings.classes, h, settings.per_class),
        np.zeros((settings.classes, settings.per_class), np.float32),
    )


def _line(numbers: pa.Scalar) -> np.ndarray:
    return np.frombuffer(numbers.as_buffer(), "<u2")


def _learn_held(network: Network, held: list[np.ndarray], rng: np.random.Generator) -> None:
    if held:
        tokens, around = network.windows(held)
        order = rng.permutation(len(tokens))
        for at in range(0, len(order), network.settings.batch):
            part = order[at : at + network.settings.batch]
            network.learn(tokens[part], around[:, part])


def _train_batches(settings: Settings):
    def slices(network: Network) -> pa.RecordBatch:
        flat = network.flat()
        values = np.pad(flat, (0, -len(flat) % SLICE)).astype(np.float64)
        whole = np.rint(values / UNIT).astype(np.int64).reshape(-1, SLICE)
        return pa.RecordBatch.from_pydict(
            {
                "slice": pa.array(np.arange(len(whole))),
                "parameters": pa.array(list(whole), pa.list_(pa.int64())),
            }
        )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = network = rng = None
        held, size = [], 0
        for batch in batches:
            for own, numbers in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if own != shard:
                    if network is not None:
                        _learn_held(network, held, rng)
                        yield slices(network)
                    shard, network, held, size = own, new_network(settings), [], 0
                    rng = np.random.default_rng([settings.seed, own])
                line = _line(numbers)
                held.append(line)
                size += len(line)
                if size >= HELD_TOKENS:
                    _learn_held(network, held, rng)
                    held, size = [], 0
        if network is not None:
            _learn_held(network, held, rng)
            yield slices(network)

    return train


def trained(lines: DataFrame, settings: Settings) -> Network:
    """The network after every shard of the encoded documents has trained it and been averaged."""
    network = new_network(settings)
    used = lines.filter("n_tokens > 0")
    tokens = used.agg(F.sum("n_tokens")).first()[0] or 0
    shards = 1 + tokens // settings.shard_tokens
    key = F.xxhash64("doc_id", "numbers")
    rows = (
        used.select(F.pmod(key, F.lit(shards)).alias("shard"), "numbers", key.alias("key"))
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", "key", "numbers")
        .select("shard", "numbers")
        .mapInArrow(_train_batches(settings), "slice long, parameters array<long>")
        .groupBy("slice")
        .agg(F.array(*[F.sum(F.col("parameters")[i]) for i in range(SLICE)]).alias("total"), F.count("*").alias("n"))
        .collect()
    )
    if rows:
        rows.sort(key=lambda row: row.slice)
        values = np.concatenate([np.array(row.total) * (UNIT / row.n) for row in rows])
        network.fill(values[: network.flat().size])
    return network


def _score_batches(network: Network):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(1).to_numpy()
            ends = np.cumsum(counts)
            start = 0
            while start < len(counts):
                seen = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, seen + HELD_TOKENS, side="right")))
                part = batch.slice(start, stop - start)
                start = stop
                lines = [_line(numbers) for numbers in part.column(2)]
                held = part.column(1).to_numpy()
                sums = part.column(3).to_numpy()
                if held.sum():
                    values = network.log_probabilities(*network.windows(lines))
                    sums = sums + np.bincount(np.repeat(np.arange(len(held)), held), values, len(held))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sums)],
                    names=["doc_id", "n_tokens", "log_likelihood"],
                )

    return score


def document_scores(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_tokens, log_likelihood and its mean per token of every document."""
    counts = word_counts(docs, settings)
    words = vocabulary(counts, settings)
    lines = encoded(docs, words, settings, spelling(counts, words))
    network = trained(lines, settings)
    scored = lines.mapInArrow(_score_batches(network), "doc_id long, n_tokens long, log_likelihood double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.withColumn("mean_log_likelihood", mean)
