"""Removal of byte strings that occur more than once, by bounded BWT intervals.

A string of ``length`` bytes is repeated if it starts at two places of the corpus,
inside one document or in two.  Every byte covered by a repeated string is removed.

1. Winnowing names *anchors*: places whose ``gram`` bytes hash least in some window of
   one string.  Each string has one anchor, and equal strings have the same at the same
   place, so a string is judged with the other occurrences of its anchor only.
2. An anchor comes with its *piece*, all bytes of the strings whose anchor it is.
   Pieces are counted by two 64-bit hashes: a piece that occurs twice is covered whole,
   an anchor that occurs once covers nothing.
3. What is left are anchors whose pieces differ.  A string lies in one of three zones by
   its distance from the anchor, and each zone's strings share a core of bytes; a piece
   none of whose cores occurs twice covers nothing.  The other distinct pieces are dealt by
   anchor, laid end to end in blocks of bounded size, and sorted to the depth of one
   string.  Over the block's Burrows-Wheeler transform, intervals are extended backwards
   breadth first: level by level this finds the boundaries with common prefixes of 0, 1,
   2, ... bytes and stops at ``length``.  Suffixes not parted by then share a string.
   It counts where the anchor and the distance to it agree, which keeps a place from
   being compared with itself.
4. An anchor with more than ``HOT_PIECES`` distinct pieces is not laid into one block:
   its pieces' strings are counted by hash in a shuffle of their own.

Documents are found again by row number, so the table must be one whose scan gives the
same rows in the same partitions each time (files, a stored table).

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing; very
long texts are hashed in overlapping segments; texts of one repeated byte or phrase are
covered by their own overlaps; repeated rows cover each other; a null doc_id stays null;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored, text_chunks

LENGTH = 200
GRAM = 64
HOT_PIECES = 1000
BLOCK_BYTES = 200_000
SEGMENT = 1 << 20
#: Bits that number the places of a segment and of what strings reach beyond it.
PLACE_BITS = 21


class RollingHash:
    """Hashes of all substrings from prefix sums modulo 2**64."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
        base = int(rng.integers(0, 1 << 62)) * 8 + 5
        inverse = pow(base, -1, 1 << 64)
        self.powers, self.inverses = _powers(base), _powers(inverse)

    def sums(self, text: np.ndarray) -> np.ndarray:
        out = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.values[text] * self.powers[: len(text)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of text[start:end]."""
        value = (sums[end] - sums[start]) * self.inverses[start]
        value ^= (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mixed(value)

    def grams(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Mixed hashes of text[i : i + width] for every i."""
        count = len(sums) - width
        return mixed((sums[width:] - sums[:count]) * self.inverses[:count])


def _powers(base: int) -> np.ndarray:
    count = SEGMENT + 4 * LENGTH
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(31))
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(30)
    value *= np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def _running(values: np.ndarray, width: int, best) -> np.ndarray:
    """best over each run of ``width`` values, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = best(out[: len(out) - step], out[step:])
        done += step
    return out


def anchors(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places with the least hash of some run of ``width`` places, first and last of these runs.

    Each run has one place, the leftmost of those whose hashes agree in all but the low bits.
    """
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    places = (_running(keys, width, np.minimum) & low).astype(np.int64)
    parted = np.flatnonzero(np.diff(places))  # the place never moves left as runs move right
    first = np.append(0, parted + 1)
    return places[first], first, np.append(parted, len(places) - 1)


def zones(length: int, gram: int) -> list[tuple[int, int]]:
    """For strings that start in three ranges before the anchor, the bytes all of them hold."""
    cuts = [round((length - gram) * k / 3) for k in range(4)]
    return [(-near, length - far) for near, far in zip(cuts[:-1], cuts[1:], strict=True)]


class Finder:
    """Anchors of a text with the hashes of their grams and pieces."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM) -> None:
        self.length, self.gram = length, gram
        self.first, self.second = RollingHash(1), RollingHash(2)

    def find(self, data: bytes) -> tuple[np.ndarray, ...]:
        """Places, gram hashes, piece hashes, 21 bits of each zone's core, piece bounds.

        A piece holds the strings that have the anchor for their own.  An anchor on the
        border of two segments has a piece in each, with different strings.
        """
        parts = []
        before = self.length - self.gram
        for start in range(0, max(1, len(data) - self.length + 1), SEGMENT):
            low, stop = max(0, start - before), start + SEGMENT + self.length - 1
            high = min(len(data), stop + self.length)
            if stop - start < self.length or len(data) - start < self.length:
                continue
            text = np.frombuffer(data, np.uint8, high - low, low)
            one, two = self.first.sums(text), self.second.sums(text)
            grams = self.first.grams(one, self.gram)
            own = grams[start - low : min(len(data), stop) - low - self.gram + 1]
            at, left, right = (x + start - low for x in anchors(own, before + 1))
            right += self.length
            pieces = self.second.between(two, left, right) ^ mixed((at - left).astype(np.uint64))
            gram = self.first.between(one, at, at + self.gram)
            cores = np.zeros(len(at), np.uint64)
            for start_, stop_ in zones(self.length, self.gram):
                # The zone's strings start from at - (length - stop_) to at + start_.
                inside = (left <= at + start_) & (right >= at + stop_)
                core = self.second.between(two, np.maximum(at + start_, 0), np.minimum(at + stop_, len(text)))
                # 0 stands for "no string of the zone has this anchor".
                bits = np.where(inside, core % np.uint64((1 << 21) - 1) + np.uint64(1), np.uint64(0))
                cores = (cores << np.uint64(21)) | bits
            parts.append((at + low, gram, pieces, cores, left + low, right + low))
        if not parts:
            places, hashes = np.empty(0, np.int64), np.empty(0, np.uint64)
            return places, hashes, hashes, hashes, places, places
        return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _anchor_batches(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(length, gram)
        for batch, held in text_chunks(batches):
            rows = batch.column(0).to_numpy()
            found = [finder.find(text.encode("utf-8", "surrogatepass")) for text in held]
            counts = [len(x[0]) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([x[1] for x in found]).view(np.int64)),
                    pa.array(np.concatenate([x[2] for x in found]).view(np.int64)),
                    pa.array(np.repeat(rows, counts)),
                    pa.array(np.concatenate([x[0] for x in found])),
                    pa.array(np.concatenate([x[3] for x in found]).view(np.int64)),
                    pa.array(np.concatenate([x[0] - x[4] for x in found]).astype(np.int16)),
                    pa.array(np.concatenate([x[5] - x[0] for x in found]).astype(np.int16)),
                ],
                names=["anchor", "piece", "row", "place", "cores", "behind", "ahead"],
            )

    return find


def numbered(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def repeated_anchors(rows: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """Stored occurrences of anchors that occur at least twice.

    copies: occurrences of this piece; wanted: this is the one occurrence that stands for its piece, and a core of it occurs
    in another piece; hot: too many of these.
    """
    found = rows.select("row", "text").mapInArrow(
        _anchor_batches(length, gram),
        "anchor long, piece long, row long, place long, cores long, behind short, ahead short",
    )
    same_anchor, same_piece = Window.partitionBy("anchor"), Window.partitionBy("anchor", "piece")
    marked = (
        found.withColumn("all", F.count("*").over(same_anchor))
        .filter("all > 1")
        .withColumn("copies", F.count("*").over(same_piece))
        .withColumn("first", F.row_number().over(same_piece.orderBy("row", "place", "behind")) == 1)
    )
    zones_shared = F.lit(0)
    for k in range(3):
        core = F.shiftrightunsigned("cores", 21 * k).bitwiseAND(F.lit((1 << 21) - 1))
        same_core = Window.partitionBy("anchor", f"core{k}")
        marked = marked.withColumn(f"core{k}", core).withColumn(
            f"held{k}", F.sum(F.col("first").cast("int")).over(same_core)
        )
        shared = (F.col(f"core{k}") > 0) & (F.col(f"held{k}") > 1)
        zones_shared = zones_shared + F.when(shared, 4 >> k).otherwise(0)
    marked = (
        marked.withColumn("zones", zones_shared)
        .withColumn("first", F.col("first") & (F.col("zones") > 0))
        .withColumn("pieces", F.sum(F.col("first").cast("int")).over(same_anchor))
    )
    return stored(
        marked.select(
            "row", "place", "anchor", "behind", "ahead", "copies", "zones",
            (F.col("first") & (F.col("pieces") > 1)).alias("wanted"),
            (F.col("pieces") > hot).alias("hot"),
        ).filter("copies > 1 OR wanted"),
        "anchors",
    )


PIECES = "anchor long, row long, place long, single boolean, hot boolean, zones int, before int, bytes binary"


def _piece_batches(length: int, gram: int):
    """The bytes that strings of the marked zones can reach."""
    limits = [(-low, length - high) for low, high in zones(length, gram)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in text_chunks(batches):
            out: list[list] = [[] for _ in range(8)]
            for row, marks, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), held, strict=True
            ):
                data = text.encode("utf-8", "surrogatepass")
                for mark in marks:
                    place = mark["place"]
                    used = [limits[k] for k in range(3) if mark["zones"] & (1 << k)]
                    low = place - min(mark["behind"], max(far for _, far in used))
                    high = place + min(mark["ahead"], length - min(near for near, _ in used))
                    piece = data[low:high]
                    if len(piece) >= length:
                        values = (
                            mark["anchor"], row, place, mark["copies"] == 1, mark["hot"],
                            mark["zones"], place - low, piece,
                        )
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            kinds += (pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["anchor", "row", "place", "single", "hot", "zones", "before", "bytes"],
            )

    return cut


def sorted_to_depth(text: np.ndarray, separators: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` symbols; text holds bytes + 1 and 0 at separators.

    A separator is less than any byte and than the separators after it.  The first sort
    takes as many symbols as a 63-bit key holds; each later one joins the ranks of three
    neighbouring stretches (two in a text too long for that), so the depth triples.
    """
    n = len(text)
    codes = np.cumsum(np.bincount(text, minlength=257) > 0) - 1  # dense, in the same order
    base = int(codes[-1]) + 1
    width = 1
    while base ** (width + 1) < 1 << 63:
        width += 1
    ahead = np.minimum(separators[np.searchsorted(separators, np.arange(n))] - np.arange(n), width)
    padded = np.append(codes[text], np.zeros(width, np.int64))
    key = np.zeros(n, np.int64)
    for k in range(width):  # symbols past a separator count as zero
        key = key * base + np.where(k < ahead, padded[k : k + n], 0)
    order = np.argsort(key)
    ended = ahead[order] < width
    tied = order[ended]
    order[ended] = tied[np.lexsort((tied, key[tied]))]
    new = np.append(True, (np.diff(key[order]) != 0) | ended[1:] | ended[:-1])
    places = np.arange(n)
    rank = np.empty(n, np.int64)  # the first place of a suffix's group
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    done, stretches = width, 3 if n < 1 << 21 else 2
    while done < depth:
        open_ = places[~(new & np.append(new[1:], True))]  # places in groups of several
        if not len(open_):
            break
        held = order[open_]
        # Ranks count only where all before them tie, and then no separator lies between.
        key = rank[held]
        for k in range(1, stretches):
            key = key * n + rank[np.minimum(held + k * done, n - 1)]
        sort = np.argsort(key, kind="stable")  # quick on keys already in order of groups
        held, key = held[sort], key[sort]
        order[open_] = held
        fresh = np.append(True, np.diff(key) != 0)
        new[open_] = fresh
        rank[held] = np.maximum.accumulate(np.where(fresh, open_, 0))
        done *= stretches
    return order


def common_prefix_classes(text: np.ndarray, order: np.ndarray, pieces: int, length: int) -> np.ndarray:
    """Class of each suffix in sorted order; equal classes share ``length`` symbols.

    Intervals over the Burrows-Wheeler transform are extended backwards, breadth first.
    The boundary behind an interval of a string of m symbols has a common prefix of
    m - 1 if none was found before; intervals without news are not extended again.
    """
    n = len(text)
    before = text[order - 1]  # the transform; the text ends in a separator, which wraps
    step = np.empty(n, np.int32)
    step[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    parted = np.zeros(n + 1, bool)
    parted[: pieces + 1] = parted[n] = True
    heads, owners = text[order], np.empty(n, np.int32)
    starts = np.searchsorted(heads, np.arange(1, 258))
    low, high = starts[:-1], starts[1:]
    held = high > low
    low, high = low[held], high[held]
    parted[high] = True
    low = np.concatenate((np.arange(pieces), low))
    high = np.concatenate((np.arange(1, pieces + 1), high))
    for _ in range(1, length):
        if not len(low):
            break
        sizes = high - low
        owner = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
        shift = (low - np.cumsum(sizes) + sizes).astype(np.int32)
        at = np.arange(len(owner), dtype=np.int32) + np.repeat(shift, sizes)
        inner = before[at] > 0  # nothing extends over a separator
        at, owner = at[inner], owner[inner]
        target = step[at]  # all different, as the intervals of a level are disjoint
        owners[target] = owner
        target = np.sort(target)
        owner, symbol = owners[target], heads[target]
        last = np.append((np.diff(target) != 1) | (np.diff(owner) != 0) | (np.diff(symbol) != 0), True)
        first = np.append(True, last[:-1])
        low, high = target[first], target[last] + 1
        news = ~parted[high]
        low, high = low[news], high[news]
        parted[high] = True
    return np.cumsum(parted[:n])


def repeated_places(
    pieces: list[bytes], groups: np.ndarray, before: np.ndarray, length: int = LENGTH
) -> list[np.ndarray]:
    """Per piece the starts of strings that another piece of its group has at that distance."""
    sizes = np.array([len(piece) for piece in pieces])
    ends = np.cumsum(sizes + 1) - 1
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int16) + 1
    text[ends] = 0
    order = sorted_to_depth(text, ends, length)
    classes = common_prefix_classes(text, order, len(pieces), length)
    owner = np.searchsorted(ends, order)
    whole = ends[owner] - order >= length
    order, owner, classes = order[whole], owner[whole], classes[whole]
    start = order - (ends[owner] - sizes[owner])
    offset = start - before[owner]
    sort = np.lexsort((offset, groups[owner], classes))
    order, owner, classes, start, offset = (x[sort] for x in (order, owner, classes, start, offset))
    same = (np.diff(classes) == 0) & (np.diff(groups[owner]) == 0) & (np.diff(offset) == 0)
    twice = np.append(False, same) | np.append(same, False)
    owner, start = owner[twice], start[twice]
    sort = np.lexsort((start, owner))
    owner, start = owner[sort], start[sort]
    cuts = np.searchsorted(owner, np.arange(len(pieces) + 1))
    return [start[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _cover(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs covered by strings that start at these sorted places."""
    gap = np.diff(starts) > length
    return starts[np.append(True, gap)], starts[np.append(gap, True)] + length


def _span_batch(rows, low, high) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
        names=["row", "low", "high"],
    )


def _block_batches(length: int, limit: int):
    def flush(held: list[dict]) -> pa.RecordBatch:
        groups = np.array([piece["anchor"] for piece in held])
        before = np.array([piece["before"] for piece in held])
        found = repeated_places([piece["bytes"] for piece in held], groups, before, length)
        rows, low, high = [], [], []
        for piece, starts in zip(held, found, strict=True):
            if piece["single"] and len(starts):
                a, b = _cover(starts + piece["place"] - piece["before"], length)
                rows += [piece["row"]] * len(a)
                low += a.tolist()
                high += b.tolist()
        return _span_batch(rows, low, high)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in batch.to_pylist():
                if size > limit and piece["anchor"] != held[-1]["anchor"]:
                    yield flush(held)
                    held, size = [], 0
                held.append(piece)
                size += len(piece["bytes"])
        if held:
            yield flush(held)

    return blocks


def _string_batches(length: int, gram: int):
    """The pieces' strings with a shared core, by anchor, distance and two hashes."""
    limits = [(length - high, -low) for low, high in zones(length, gram)]  # distances, far to near

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = RollingHash(3), RollingHash(4)
        for batch in batches:
            parts = []
            for piece in batch.to_pylist():
                text = np.frombuffer(piece["bytes"], np.uint8)
                start = np.arange(len(text) - length + 1)
                offset = start - piece["before"]
                wanted = np.zeros(len(start), bool)
                for k, bounds in enumerate(limits):
                    if piece["zones"] & (1 << k):
                        wanted |= (-offset >= min(bounds)) & (-offset <= max(bounds))
                one, two = (h.grams(h.sums(text), length)[wanted].view(np.int64) for h in (first, second))
                count = len(one)
                same = (np.full(count, piece[name]) for name in ("anchor", "row", "single"))
                parts.append((*same, offset[wanted], start[wanted] + piece["place"] - piece["before"], one, two))
            if parts:
                columns = [pa.array(np.concatenate(column)) for column in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["anchor", "row", "single", "offset", "low", "one", "two"]
                )

    return strings


def repeated_spans(
    rows: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_PIECES, limit: int = BLOCK_BYTES
) -> DataFrame:
    """row, low, high: runs of bytes covered by repeated strings (runs may overlap)."""
    marks = repeated_anchors(rows, length, gram, hot)
    whole = marks.filter("copies > 1").select(
        "row",
        (F.col("place") - F.col("behind")).alias("low"),
        (F.col("place") + F.col("ahead")).alias("high"),
    )
    wanted = marks.filter("wanted").groupBy("row").agg(
        F.collect_list(F.struct("place", "anchor", "behind", "ahead", "copies", "hot", "zones")).alias("marks")
    )
    pieces = stored(
        wanted.join(rows, "row").select("row", "marks", "text").mapInArrow(_piece_batches(length, gram), PIECES),
        "pieces",
    )
    spans = "row long, low long, high long"
    parts = (
        pieces.filter("NOT hot")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_block_batches(length, limit), spans)
    )
    same = Window.partitionBy("anchor", "offset", "one", "two")
    strings = (
        pieces.filter("hot")
        .mapInArrow(
            _string_batches(length, gram),
            "anchor long, row long, single boolean, offset long, low long, one long, two long",
        )
        .withColumn("places", F.count("*").over(same))
        .filter("places > 1 AND single")
        .select("row", "low", (F.col("low") + length).alias("high"))
    )
    return whole.unionByName(parts).unionByName(strings)


def _cut_batches(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in text_chunks(batches):
            ids, spans = batch.column(0), batch.column(1)
            out: list[list] = [[] for _ in range(4)]
            for own, text in zip(spans, held, strict=True):
                data = text.encode("utf-8", "surrogatepass")
                digest, removed, runs, at = hashlib.sha256(), 0, 0, 0
                if own.is_valid and len(data) >= length:
                    end = 0
                    pairs = sorted(zip(*(own.values.field(k).to_pylist() for k in (0, 1)), strict=True))
                    for low, high in pairs:
                        high = min(high, len(data))
                        if runs and low <= end:
                            end = max(end, high)
                            continue
                        if runs:
                            digest.update(data[at:begin])
                            removed, at = removed + end - begin, end
                        begin, end, runs = low, high, runs + 1
                    digest.update(data[at:begin])
                    removed, at = removed + end - begin, end
                digest.update(data[at:])
                for column, value in zip(out, (len(data), removed, runs, digest.hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return cut


def without_repeats(docs: DataFrame, length: int = LENGTH, **options: int) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = numbered(docs)
    spans = repeated_spans(rows, length, **options)
    of_row = spans.groupBy("row").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    return (
        rows.join(of_row, "row", "left")
        .select("doc_id", "spans", "text")
        .mapInArrow(
            _cut_batches(length),
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        )
    )
