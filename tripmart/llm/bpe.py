"""Byte-pair encoding and decoding by an index of pair occurrences.

The new word forms of a batch are laid out as one array of symbols with links to
the neighbours.  An index maps each mergeable pair's rank to the positions where the
pair occurs in the batch.  The lowest active rank is taken, all its occurrences are
merged at once, and the lists of the neighbouring pairs are updated; the next lowest
follows until no rank is active.  Word forms are kept for later batches of the task.

The tokenizer's file is read on the driver and its tables are sent to the tasks
(about two MB for 49 thousand entries; bounded by the vocabulary).

Defined cases: a null or empty text, and one of white space alone, has no tokens and
decodes to the empty text; special tokens in a text are single tokens; a document's
result does not depend on its neighbours, so repeated rows give equal results; a null
doc_id stays null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from tripmart.llm.common import text_chunks, texts

WORD_END = "</w>"
#: Fixed by the tokenizer's file: its pattern of words, white space written out.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACES + r"\p{L}\p{N}]+"
NFC, LOWER = normalizers.NFC(), normalizers.Lowercase()
KEPT_WORDS = 300_000
#: Texts with letters from here on may hold code points that Unicode versions class apart.
SCRIPTS = regex.compile("[\u0530-\U0010ffff]")
BATCH_CHARS = 16_000_000


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(shown))
    return [letters[b] for b in range(256)]


@dataclass
class Tables:
    """Vocabulary and merges as arrays; pairs are sorted by left * size + right."""

    tokens: list[str]
    special: dict[str, int]
    inner: np.ndarray
    final: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    left: np.ndarray
    right: np.ndarray
    product: np.ndarray
    #: Ranks whose product can take part in a merge of a lower rank.
    unordered: frozenset[int]

    @property
    def size(self) -> int:
        return len(self.tokens)


def load_tables(path: str) -> Tables:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
        raise ValueError("a BPE tokenizer with word ends is needed")
    vocabulary = model["vocab"]
    special = {entry["content"]: entry["id"] for entry in content["added_tokens"]}
    size = max([*vocabulary.values(), *special.values()]) + 1
    tokens = [""] * size
    for token, number in (vocabulary | special).items():
        tokens[number] = token
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
    right = np.array([vocabulary[b] for _, b in pairs], np.int64)
    product = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
    first_use = np.full(size, len(pairs))
    for rank in range(len(pairs) - 1, -1, -1):
        first_use[left[rank]] = first_use[right[rank]] = rank
    order = np.argsort(left * size + right, kind="stable")
    letters = byte_letters()
    return Tables(
        tokens,
        special,
        np.array([vocabulary[x] for x in letters], np.int64),
        np.array([vocabulary[x + WORD_END] for x in letters], np.int64),
        (left * size + right)[order],
        order,
        left,
        right,
        product,
        frozenset(np.flatnonzero(first_use[product] < np.arange(len(pairs))).tolist()),
    )


class PairIndex:
    """Occurrences of mergeable pairs in the words of one batch."""

    def __init__(self, words: list[bytes], tables: Tables) -> None:
        self.tables = tables
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        symbols = tables.inner[flat]
        symbols[ends - 1] = tables.final[flat[ends - 1]]
        count = len(flat)
        self.word = np.repeat(np.arange(len(words)), lengths)
        #: One more place, which stands for "no neighbour".
        self.symbols = np.append(symbols, -1)
        self.after = np.append(np.arange(1, count + 1), count)
        self.before = np.append(np.arange(-1, count - 1), count)
        self.after[ends - 1] = count
        self.before[ends - lengths] = count
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(np.arange(count))

    def _add(self, places: np.ndarray) -> None:
        """Enter the pairs that start at these places."""
        after = self.after[places]
        keys = self.symbols[places] * self.tables.size + self.symbols[after]
        keys[self.symbols[after] < 0] = -1
        at = np.minimum(np.searchsorted(self.tables.pair_keys, keys), len(self.tables.pair_keys) - 1)
        known = self.tables.pair_keys[at] == keys
        places, ranks = places[known], self.tables.pair_ranks[at[known]]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        starts = [0, *cuts.tolist()]
        for a, b in zip(starts, [*starts[1:], len(ranks)], strict=True):
            rank = int(ranks[a])
            if rank not in self.lists:
                self.lists[rank] = []
                heapq.heappush(self.active, rank)
            self.lists[rank].append(places[a:b])

    def merge_all(self) -> None:
        while self.active:
            rank = heapq.heappop(self.active)
            held = self.lists.pop(rank)
            places = held[0] if len(held) == 1 else np.concatenate(held)
            self._merge(rank, places)

    def _merge(self, rank: int, places: np.ndarray) -> None:
        tables, symbols = self.tables, self.symbols
        left, right = tables.left[rank], tables.right[rank]
        places = places[(symbols[places] == left) & (symbols[self.after[places]] == right)]
        if not len(places):
            return
        places = np.unique(places)
        if left == right:  # in a run of equal symbols, every other pair from the left
            linked = np.append(False, self.after[places[:-1]] == places[1:])
            index = np.arange(len(places))
            run_start = np.maximum.accumulate(np.where(linked, 0, index))
            places = places[(index - run_start) % 2 == 0]
        if rank in tables.unordered:  # one per word, then the order is looked at anew
            _, first = np.unique(self.word[places], return_index=True)
            rest = np.setdiff1d(places, places[first])
            places = places[first]
        else:
            rest = places[:0]
        gone = self.after[places]
        symbols[places] = tables.product[rank]
        symbols[gone] = -1
        beyond = self.after[gone]
        self.after[places] = beyond
        self.before[beyond] = places
        before = self.before[places]
        none = len(symbols) - 1
        self._add(np.concatenate((places, before[before != none], rest)))

    def result(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, and where each word's ids start."""
        alive = self.symbols[:-1] >= 0
        counts = np.bincount(self.word[alive], minlength=words)
        return self.symbols[:-1][alive], np.concatenate(([0], np.cumsum(counts)))


class Encoder:
    """Encodes texts; word forms are remembered within a task."""

    def __init__(self, tables: Tables) -> None:
        self.tables = tables
        self.pattern = regex.compile(WORDS)
        marks = "|".join(map(regex.escape, sorted(tables.special, key=len, reverse=True)))
        self.split = pre_tokenizers.Split(Regex(WORDS.replace(SPACES, r"\s")), "removed", invert=True)
        self.special = regex.compile(f"({marks})") if marks else None
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.decoded: list[str] = []
        for token, number in self.tables.special.items():
            self.numbers["\0" + token] = len(self.ids)
            self.ids.append(np.array([number], np.int64))
            self.decoded.append(self.decode([number]))

    def decode(self, ids) -> str:
        """The tokens' texts with a blank between them."""
        return " ".join([self.tables.tokens[i] for i in ids])

    def _words(self, text: str) -> list[str]:
        parts = self.special.split(text) if self.special and "<" in text else [text]
        words: list[str] = []
        for k, part in enumerate(parts):
            if k % 2:
                words.append("\0" + part)
                continue
            if SCRIPTS.search(part) and any(unicodedata.category(c) == "Cn" for c in set(part)):
                plain = LOWER.normalize_str(NFC.normalize_str(part))
                words += [word for word, _ in self.split.pre_tokenize_str(plain)]
                continue
            # Letters are lower-cased one by one: a sigma's form does not depend on its place.
            plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            words += self.pattern.findall(plain)
        return words

    def encode_batch(self, held: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Each text's ids and decoded text."""
        if len(self.numbers) > KEPT_WORDS:
            self.reset()
        numbers, known = self.numbers, len(self.numbers)
        lines = []
        for text in held:
            words = self._words(text)
            for word in set(words).difference(numbers):
                numbers[word] = len(numbers)
            lines.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        new = [word for word, n in numbers.items() if n >= known] if len(numbers) > known else []
        if new:
            index = PairIndex([word.encode("utf-8", "surrogatepass") for word in new], self.tables)
            index.merge_all()
            flat, starts = index.result(len(new))
            bounds = starts.tolist()
            names = list(map(self.tables.tokens.__getitem__, flat.tolist()))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                self.ids.append(flat[a:b])
                self.decoded.append(" ".join(names[a:b]))
        for line in lines:
            order = line.tolist()
            ids = [self.ids[n] for n in order]
            yield (
                np.concatenate(ids) if ids else np.empty(0, np.int64),
                " ".join([self.decoded[n] for n in order]),
            )


def encode_texts(held: list[str], tables: Tables) -> list[tuple[list[int], str]]:
    """Ids and decoded text of a few texts, outside Spark."""
    return [(ids.tolist(), text) for ids, text in Encoder(tables).encode_batch(held)]


def _encode_batches(tables: Tables, with_tokens: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables)
        for batch, held in text_chunks(batches, BATCH_CHARS):
            rows = []
            for ids, decoded in encoder.encode_batch(held):
                digest = hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest()
                back = hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()
                extra = (ids.astype(np.int32).tolist(), decoded) if with_tokens else ()
                rows.append((len(ids), digest, back, *extra))
            columns = list(zip(*rows, strict=True))
            arrays = [
                batch.column(0),
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.string()),
                pa.array(columns[2], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_tokens:
                arrays += [pa.array(columns[3], pa.list_(pa.int32())), pa.array(columns[4], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return encode


def encoded(docs: DataFrame, path: str, with_tokens: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256; on request ids and decoded too."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_tokens:
        schema += ", ids array<int>, decoded string"
    return texts(docs).mapInArrow(_encode_batches(load_tables(path), with_tokens), schema)
