"""Benchmark passages inside documents: SimHash of item-sized windows.

A window has as many words as a benchmark item.  Its SimHash, built from weighted
word shingles, is looked up in a multi-index: fingerprints within RADIUS bits agree
to within RADIUS // BLOCKS bits in at least one of the BLOCKS blocks, so the index
returns every item in the radius.  Candidates are then verified by the exact
weighted-shingle similarity (Dice's, a shingle weighing the inverse of the number of
items that hold it, 1 if none does).

Only windows with at least one shingle of an item of their size are fingerprinted, and
looked up among the items that share a shingle with their stretch of the text: any other
pair has similarity zero.  The index takes time in proportion to the items, a search holds
a bounded stretch of a long text.  The radius lies four standard deviations
beyond the expected distance at the similarity asked for.

The benchmark goes to the tasks in slices of at most ``SLICE_CHARS`` characters, one
pass over the documents for each.  Holders are counted over the whole benchmark before,
and every slice gets those of all shingles that more than one item holds (a window may
have shingles of another slice's items), so results do not depend on the slices.

Defined cases: a null text, or one with fewer words than an item, has no window of
that size; items without words or without an id match nothing; an item with fewer
words than a shingle is one shingle; of equal similarities the first window is
reported; repeated documents and items are reported each; empty tables give an empty
result; other columns are ignored by the search and kept by the filter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import text_chunks, texts

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 26
BLOCKS = 4
SLICE_CHARS = 8_000_000
WORD = re.compile(r"\w+")
FLAGS = 1 << 20
#: Pairs of a window and an item, and windows of a text, that are held at once.
HELD_PAIRS, HELD_WINDOWS = 4_000_000, 16_384


class WordHashes(dict):
    """Words to 64-bit hashes, kept until there are too many."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, text: str) -> np.ndarray:
        if len(self) > 300_000:
            self.clear()
        words = WORD.findall(text.lower())
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A mixed 64-bit hash of each run of ``width`` words."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = words[:count].copy()
    for k in range(1, width):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[k : count + k]
    total ^= total >> np.uint64(30)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(27)
    total *= np.uint64(0x94D049BB133111EB)
    return total ^ (total >> np.uint64(31))


def _signs(hashes: np.ndarray) -> np.ndarray:
    """One row of 64 signs for each hash."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.float64) * 2 - 1


def _prints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 1e-9, axis=1).view(">u8").astype(np.uint64).ravel()


class Items:
    """Items of one size: fingerprints, their blocks, and shingle weights."""

    def __init__(self, size: int, ids: list[int], bags: list[Counter], weight_of) -> None:
        self.size, self.ids = size, ids
        self.bags = bags
        self.weight = [sum(n * weight_of(s) for s, n in bag.items()) for bag in bags]
        sums = [
            _signs(np.array(list(bag), np.uint64)).T
            @ np.array([n * weight_of(s) for s, n in bag.items()])
            for bag in bags
        ]
        self.prints = _prints(np.array(sums))

    def near(self, prints: np.ndarray, items: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) pairs within RADIUS bits, found through the blocks.

        items are those that share a shingle with one of the windows; no more than
        HELD_PAIRS pairs are looked at at once.
        """
        blocks = [
            np.unique(_block(self.prints[items], b), return_inverse=True) for b in range(BLOCKS)
        ]
        step = max(1, HELD_PAIRS // len(items))
        for start in range(0, len(prints), step):
            held = prints[start : start + step]
            found = np.zeros((len(held), len(items)), bool)
            for b, (values, owner) in enumerate(blocks):
                own, place = np.unique(_block(held, b), return_inverse=True)
                close = np.bitwise_count(own[:, None] ^ values[None, :]) <= RADIUS // BLOCKS
                found |= close[place][:, owner]
            window, item = np.nonzero(found)
            item = items[item]
            within = np.bitwise_count(held[window] ^ self.prints[item]) <= RADIUS
            yield from zip((window[within] + start).tolist(), item[within].tolist(), strict=True)


def _block(prints: np.ndarray, b: int) -> np.ndarray:
    width = 64 // BLOCKS
    return (prints >> np.uint64(width * b)) & np.uint64((1 << width) - 1)


class Index:
    """The benchmark's items by size, and which shingles occur at each size."""

    def __init__(
        self, items: list[tuple[int, str]], holders: dict[int, int], width: int = SHINGLE_WORDS
    ) -> None:
        """holders: how many items of the whole benchmark hold a shingle, if more than one."""
        hashes = WordHashes()
        self.width = width
        by_size: dict[int, list[tuple[int, Counter]]] = {}
        self.holders = holders
        for item_id, text in items:
            words = hashes.of(text or "")
            if len(words) and item_id is not None:
                bag = Counter(shingles(words, min(width, len(words))).tolist())
                by_size.setdefault(len(words), []).append((item_id, bag))
        self.groups = [
            Items(size, [i for i, _ in held], [bag for _, bag in held], self.weight)
            for size, held in sorted(by_size.items())
        ]
        #: Per shingle width: known shingles, quick flags, and the items of each group that hold each.
        self.known = {}
        for k in sorted({min(width, group.size) for group in self.groups}):
            own = [g for g in self.groups if min(width, g.size) == k]
            holding: dict[int, dict[int, list[int]]] = {}
            for place, group in enumerate(own):
                for item, bag in enumerate(group.bags):
                    for s in bag:
                        holding.setdefault(s, {}).setdefault(place, []).append(item)
            values = np.array(sorted(holding), np.uint64)
            flags = np.zeros(FLAGS, bool)
            flags[(values & np.uint64(FLAGS - 1)).astype(np.int64)] = True
            places = [[(own[g], items) for g, items in holding[s].items()] for s in values.tolist()]
            self.known[k] = (values, flags, places)

    def weight(self, shingle: int) -> float:
        return 1.0 / max(1, self.holders.get(shingle, 0))

    def search(self, words: np.ndarray, similarity: float) -> dict[int, tuple[float, int, int]]:
        """Per item id: best similarity, its first word, and its Hamming distance."""
        best: dict[int, tuple[float, int, int]] = {}
        for width, (values, flags, places) in self.known.items():
            hashes = shingles(words, width)
            maybe = np.flatnonzero(flags[(hashes & np.uint64(FLAGS - 1)).astype(np.int64)])
            if not len(maybe):
                continue
            rank = np.minimum(np.searchsorted(values, hashes[maybe]), len(values) - 1)
            true = values[rank] == hashes[maybe]
            starts: dict[int, tuple[Items, list[int], list[list[int]]]] = {}
            for at, place in zip(maybe[true].tolist(), rank[true].tolist(), strict=True):
                for group, items in places[place]:
                    _, hits, holding = starts.setdefault(group.size, (group, [], []))
                    hits.append(at)
                    holding.append(items)
            for group, hits, holding in starts.values():
                self._windows(group, width, hashes, hits, holding, similarity, best)
        return best

    def _windows(self, group, width, hashes, hits, holding, similarity, best) -> None:
        """Verify the windows of the group's size around the hits."""
        span = group.size - width + 1
        last = len(hashes) - span
        if last < 0:
            return
        at = np.asarray(hits)
        opened = np.concatenate(([0], np.flatnonzero(np.diff(at) > 64 * span) + 1, [len(at)]))
        for a, b in zip(opened[:-1].tolist(), opened[1:].tolist(), strict=True):
            first, end = max(0, int(at[a]) - span + 1), min(last, int(at[b - 1]))
            for low in range(first, end + 1, HELD_WINDOWS):
                high = min(end, low + HELD_WINDOWS - 1)
                c, d = np.searchsorted(at, (low, high + span)).tolist()
                if d > c:
                    # Equal lists are one object, as they belong to one shingle.
                    lists = {id(items): items for items in holding[c:d]}
                    items = np.array(sorted(set().union(*lists.values())))
                    self._region(group, items, hashes, at[c:d], span, low, high, similarity, best)

    def _region(self, group, items, hashes, hits, span, low, high, similarity, best) -> None:
        touched = np.zeros(high - low + 2, np.int64)
        np.add.at(touched, np.clip(hits - span + 1 - low, 0, None), 1)
        np.add.at(touched, np.minimum(hits - low, high - low) + 1, -1)
        windows = np.flatnonzero(np.cumsum(touched[:-1]) > 0)
        local = hashes[low : high + span]
        weights = np.array([self.weight(s) for s in local.tolist()])
        sums = np.zeros((len(local) + 1, 64))
        np.cumsum(_signs(local) * weights[:, None], axis=0, out=sums[1:])
        prints = _prints(sums[windows + span] - sums[windows])
        for w, item in group.near(prints, items):
            start = int(windows[w])
            score = self._dice(group, item, local[start : start + span])
            key = group.ids[item]
            if score >= similarity and score > best.get(key, (0.0,))[0] + 1e-12:
                distance = int(np.bitwise_count(prints[w] ^ group.prints[item]))
                best[key] = (score, low + start, distance)

    def _dice(self, group: Items, item: int, window: np.ndarray) -> float:
        bag = Counter(window.tolist())
        shared = sum(min(n, bag[s]) * self.weight(s) for s, n in group.bags[item].items() if s in bag)
        own = sum(n * self.weight(s) for s, n in bag.items())
        return 2 * shared / (own + group.weight[item])


def _holder_batches(width: int):
    def shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for _, held in text_chunks(batches):
            lines = [hashes.of(text) for text in held]
            own = [np.unique(shingles(words, min(width, len(words)))) for words in lines if len(words)]
            if own:
                yield pa.RecordBatch.from_pydict({"shingle": pa.array(np.concatenate(own).view(np.int64))})

    return shingles_of


def shared_holders(items: DataFrame, width: int = SHINGLE_WORDS) -> dict[int, int]:
    """How many items hold each shingle that more than one holds."""
    counted = (
        items.select("text")
        .mapInArrow(_holder_batches(width), "shingle long")
        .groupBy("shingle")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .toArrow()
    )
    found = counted["shingle"].to_numpy().view(np.uint64).tolist()
    return dict(zip(found, counted["n"].to_pylist(), strict=True))


def indexes(benchmark: DataFrame, limit: int = SLICE_CHARS) -> Iterator[Index]:
    """The benchmark's index, in slices of about ``limit`` characters at most."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("item_id IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = 1 + total // limit
    holders = shared_holders(items)
    for k in range(slices):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k)
        yield Index(sorted((row.item_id, row.text) for row in part.collect()), holders)


def _match_batches(index: Index, similarity: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, held in text_chunks(batches):
            ids = batch.column(0).to_pylist()
            rows = [
                (doc_id, item, *found)
                for doc_id, text in zip(ids, held, strict=True)
                for item, found in index.search(hashes.of(text), similarity).items()
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "item_id", "similarity", "first_word", "distance"],
            )

    return match


def leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, limit: int = SLICE_CHARS
) -> DataFrame:
    """One row per document and item found in it: similarity, first word, distance."""
    schema = "doc_id long, item_id long, similarity double, first_word long, distance int"
    parts = [texts(docs).mapInArrow(_match_batches(i, similarity), schema) for i in indexes(benchmark, limit)]
    return reduce(DataFrame.unionByName, parts)


def _clean_batches(index: Index, similarity: float):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, held in text_chunks(batches):
            keep = [not index.search(hashes.of(text), similarity) for text in held]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return clean


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    for index in indexes(benchmark):
        docs = docs.mapInArrow(_clean_batches(index, similarity), docs.schema)
    return docs
