"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

Two fingerprints that differ in at most three of 64 bits agree in one of four
16-bit blocks, and within the other 48 bits again in one of four 12-bit blocks.
Distinct fingerprints are dealt by these 16 keys of 28 bits; inside a key the
Hamming distance is verified.  A key emits the spanning links of its components
instead of all pairs.  A key with many members is cut into chunks, and every pair
of chunks is compared in a task of its own.

Defined cases: a null text is empty; a text without words has fingerprint zero and
is linked like any other; fewer words than a shingle give one shingle; repeated
rows stay rows of one component; a null doc_id belongs to its fingerprint's
component but never names it (``component_id`` is null if no member has an id); an
empty table gives an empty result; other columns are ignored.

Near copies by similarity (``similar_links``) are pairs whose sets of shingles have a
Jaccard similarity of at least a bound.  At 0.8 a seventh of a pair's bits differ, ten of
64, too many for blocks of 64 bits; the fingerprint of a set is therefore wide: 64 blocks
of 13 bits.  Fingerprints that differ in less than 64 of the 832 bits agree in a block, and
a pair at 0.8 (126 bits expected) agrees in none once in 3,000.  Rows that agree in a block
are candidates; the Hamming distance of their first 128 bits and their sizes say which may
be similar.  The set of each such row moves once, to the others that it is chained to, and
the shingles themselves decide.  Rows of equal sets are folded first.  Texts without words
are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import fresh, stored, text_chunks, texts
from tripmart.llm.components import components
from tripmart.llm.exact import UPPER

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
CHUNK = 2048
#: Shingles whose sets a task holds at once for one chunk of similar rows (32 MB).
BULK = 4_000_000
#: Blocks of a wide fingerprint, their bits, and how many of its first 128 bits a similar pair
#: may differ in: at 0.8 nineteen are expected, and more than 34 are found once in 3,600.
BLOCKS, BLOCK_BITS, SIMILAR_BITS = 64, 13, 34
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, BLOCKS * BLOCK_BITS // 32, np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def shingle_hashes(text: str, width: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle of ASCII-lower-cased words, repeats included."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -width] + 1))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[i:j], SEED) for i, j in pairs), np.uint64, len(starts))


def majority_bits(hashes: np.ndarray) -> int:
    """The integer whose bits are those set in over half the hashes."""
    totals = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65_280):
        part = hashes[start : start + 65_280]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        whole = len(bits) // 255 * 255  # sums of 255 bits fit a byte
        if whole:
            sums = bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8)
            totals += sums.sum(axis=0, dtype=np.int64)
        totals += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * totals > len(hashes)).tobytes(), "big")


def _fingerprint_batches(width: int):
    def prints_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in text_chunks(batches):
            prints = [majority_bits(shingle_hashes(text, width)) for text in held]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "fingerprint": pa.array(signed)}
            )

    return prints_of


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fingerprint (64 bits as a long) of every document, stored."""
    table = texts(docs).mapInArrow(_fingerprint_batches(width), "doc_id long, fingerprint long")
    return stored(table, "fingerprints")


def _block_keys(fingerprint: str):
    """Sixteen keys: a 16-bit block and a 12-bit block of the other 48 bits."""
    print_ = F.col(fingerprint)
    keys = []
    for i in range(4):
        block = F.shiftrightunsigned(print_, 16 * i).bitwiseAND(F.lit(0xFFFF))
        low = print_.bitwiseAND(F.lit((1 << (16 * i)) - 1)) if i else F.lit(0).cast("long")
        high = (
            F.shiftleft(F.shiftrightunsigned(print_, 16 * (i + 1)), 16 * i)
            if i < 3
            else F.lit(0).cast("long")
        )
        rest = low.bitwiseOR(high)
        for j in range(4):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            keys.append((block * 4096 + part) * 16 + (4 * i + j))
    return F.array(*keys)


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(root, member) links of the components at Hamming distance radius."""
    open_ = np.unique(prints).view(np.uint64)  # counts of set bits need unsigned numbers
    links = []
    while len(open_) > 1:
        root, open_ = open_[0], open_[1:]
        frontier, members = [root], []
        while frontier and len(open_):
            near = np.bitwise_count(open_ ^ frontier.pop()) <= radius
            if near.any():
                found = open_[near]
                members += found.view(np.int64).tolist()
                frontier += list(found)
                open_ = open_[~near]
        links += [(int(root.view(np.int64)), x) for x in members]
    return links


def _link_batches(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[int, int]] = []
            for members in batch.column(0):
                values = members.values
                if len(values) == 2:
                    a, b = values[0].as_py(), values[1].as_py()
                    if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= radius:
                        links.append((a, b))
                else:
                    links += spanning_links(values.to_numpy(), radius)
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
            )

    return link


def close_links(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints within MAX_BITS."""
    key = Window.partitionBy("key")
    dealt = (
        prints.select("fingerprint", F.explode(_block_keys("fingerprint")).alias("key"))
        .withColumn("members", F.count("*").over(key))
        .filter("members > 1")
    )
    small = dealt.filter(F.col("members") <= chunk)
    ranked = (
        dealt.filter(F.col("members") > chunk)
        .withColumn("own", F.floor((F.row_number().over(key.orderBy("fingerprint")) - 1) / chunk))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.floor((F.col("members") - 1) / chunk))))
    )
    pairs = ranked.select(
        "key", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
        "fingerprint",
    ).repartition("key", "first", "second")
    members = F.collect_list("fingerprint").alias("members")
    groups = small.groupBy("key").agg(members).select("members").unionByName(
        pairs.groupBy("key", "first", "second").agg(members).select("members")
    )
    return groups.mapInArrow(_link_batches(MAX_BITS), "a long, b long")


def near_components(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per document: doc_id, fingerprint (long), component_id."""
    rows = fingerprints(docs)
    prints = stored(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "prints"
    )
    roots = stored(components(close_links(prints, chunk)).toDF("fingerprint", "root"), "roots")
    linked = prints.join(roots, "fingerprint")
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = roots.join(least, "root").select("fingerprint", "component_id")
    per_print = prints.join(named, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_id", "least_id").alias("component_id")
    )
    return rows.join(per_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def wide_bits(hashes: np.ndarray) -> np.ndarray:
    """The bits of a wide SimHash of a sorted set: those that over half of its shingles have set.

    A shingle's bits are the upper halves of its hash's products; where just half of the
    shingles have a bit set, the least shingle decides.
    """
    totals = np.zeros(BLOCKS * BLOCK_BITS, np.int64)
    for start in range(0, len(hashes), 255):  # sums of 255 bits fit a byte
        high = (hashes[start : start + 255, None] * _ODD >> np.uint64(32)).astype(">u4")
        bits = np.unpackbits(high.view(np.uint8), axis=1)
        totals += bits.sum(axis=0, dtype=np.uint8)
        least = bits[0] if start == 0 else least
    return 2 * totals + least > len(hashes) if len(hashes) else totals > 0


def block_keys(bits: np.ndarray) -> np.ndarray:
    """A number of each block and its bits."""
    values = bits.reshape(BLOCKS, BLOCK_BITS) @ (1 << np.arange(BLOCK_BITS))
    return ((np.arange(BLOCKS) << BLOCK_BITS) + values).astype(np.int32)


SUMMARY = "row long, digest binary, head long, tail long, size long, keys array<int>"


def _summary_batches(width: int):
    """Digest, first 128 bits of the fingerprint, size and block keys of each text's set of shingles."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in text_chunks(batches):
            found = [np.unique(shingle_hashes(text, width)) for text in held]
            wide = [wide_bits(own) for own in found]
            first = np.array([np.packbits(bits[:128]) for bits in wide]).view(">i8").astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column(0),
                    "digest": pa.array([xxhash.xxh3_128_digest(own.tobytes()) for own in found], pa.binary()),
                    "head": pa.array(first[:, 0]),
                    "tail": pa.array(first[:, 1]),
                    "size": pa.array([len(own) for own in found], pa.int64()),
                    "keys": pa.array([block_keys(bits) for bits in wide], pa.list_(pa.int32())),
                }
            )

    return summarise


def _set_batches(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in text_chunks(batches):
            found = [np.unique(shingle_hashes(text, width)).tobytes() for text in held]
            yield pa.RecordBatch.from_pydict(
                {"row": batch.column(0), "shingles": pa.array(found, pa.binary())}
            )

    return sets


def _maybe(prints: np.ndarray, sizes: np.ndarray, at, others: np.ndarray, similarity: float) -> np.ndarray:
    """Which others may be similar to the set at a place, or at a place each, by fingerprint and size."""
    bits = np.bitwise_count(prints[others] ^ prints[at])
    close = bits[:, 0] + bits[:, 1] <= SIMILAR_BITS
    return close & (sizes[others] >= similarity * sizes[at]) & (sizes[at] >= similarity * sizes[others])


def possible_links(rows: np.ndarray, prints: np.ndarray, sizes: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """(member, member) links that span the components of the pairs that may be similar."""
    open_ = np.arange(len(rows))
    links = []
    while len(open_) > 1:
        frontier, open_ = [open_[0]], open_[1:]
        while frontier and len(open_):
            at = frontier.pop()
            near = _maybe(prints, sizes, at, open_, similarity)
            links += [(int(rows[at]), x) for x in rows[open_[near]].tolist()]
            frontier += open_[near].tolist()
            open_ = open_[~near]
    return links


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first, cut only where it changes."""
    held: list[np.ndarray] = []
    for batch in batches:
        columns = [column.to_numpy() for column in batch.columns]
        if held:
            columns = [np.concatenate(both) for both in zip(held, columns, strict=True)]
        last = np.searchsorted(columns[0], columns[0][-1]) if len(columns[0]) else 0
        if last:
            yield [column[:last] for column in columns]
        held = [column[last:] for column in columns]
    if held:
        yield held


def _possible_batches(similarity: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows, head, tail, sizes in _whole_groups(batches):
            prints = np.stack([head, tail], axis=1).view(np.uint64)
            ends = np.searchsorted(group, group, "right")
            has_near = np.zeros(len(rows), bool)
            at, step = np.arange(len(rows)), 1
            while len(at := at[at + step < ends[at]]):
                near = at[_maybe(prints, sizes, at, at + step, similarity)]
                has_near[near] = has_near[near + step] = True
                step += 1
            left = np.flatnonzero(has_near)
            links: list[tuple[int, int]] = []
            for own in np.split(left, np.flatnonzero(np.diff(group[left])) + 1):
                links += possible_links(rows[own], prints[own], sizes[own], similarity)
            yield _link_batch(links)

    return link


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; two empty ones are alike."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) else 1.0


def similar_spanning_links(
    rows: np.ndarray, prints: np.ndarray, sets: list[np.ndarray], similarity: float
) -> list[tuple[int, int]]:
    """(member, member) links that span the components of the similar pairs."""
    sizes = np.array([len(own) for own in sets])
    open_ = np.arange(len(rows))
    links = []
    while len(open_) > 1:
        frontier, open_ = [open_[0]], open_[1:]
        while frontier and len(open_):
            at = frontier.pop()
            near = _maybe(prints, sizes, at, open_, similarity)
            for k in np.flatnonzero(near).tolist():
                near[k] = jaccard(sets[at], sets[open_[k]]) >= similarity
            links += [(int(rows[at]), x) for x in rows[open_[near]].tolist()]
            frontier += open_[near].tolist()
            open_ = open_[~near]
    return links


def _similar_batches(similarity: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[int, int]] = []
            for group in batch.column(0):
                rows, head, tail, sets = group.values.flatten()
                links += similar_spanning_links(
                    rows.to_numpy(),
                    np.stack([head.to_numpy(), tail.to_numpy()], axis=1).view(np.uint64),
                    [np.frombuffer(own.as_py(), np.uint64) for own in sets],
                    similarity,
                )
            yield _link_batch(links)

    return link


def _paired(table: DataFrame, key: str, chunk: int, bulk: int) -> DataFrame:
    """The rows (with size) and the two pieces ``one`` and ``two`` of their key that meet in a group.

    Keys are counted by partial sums.  A key of many rows or shingles is dealt by a hash of the
    row into pieces, and each two are a group; there is at most one such key for ``chunk`` rows
    or ``bulk`` shingles.  Any other key is one group.
    """
    pieces = F.ceil(F.greatest(F.col("members") / chunk, F.col("shingles") / bulk))
    counted = table.groupBy(key).agg(F.count("*").alias("members"), F.sum("size").alias("shingles"))
    large = stored(counted.select(key, pieces.alias("pieces")).filter("pieces > 1"), "large")
    piece = F.pmod(F.xxhash64("row", F.lit(SEED)), F.coalesce("pieces", F.lit(1)))
    others = F.sequence(F.lit(0).cast("long"), F.coalesce("pieces", F.lit(1)) - 1)
    return (
        table.join(F.broadcast(large), key, "left")
        .withColumn("piece", piece)
        .withColumn("other", F.explode(others))
        .withColumns({"one": F.least("piece", "other"), "two": F.greatest("piece", "other")})
        .drop("pieces", "piece", "other")
    )


def _possible(own: DataFrame, similarity: float, chunk: int, bulk: int) -> DataFrame:
    """Links between rows that agree in a block and may be similar, from (row, head, tail, size, keys)."""
    dealt = _paired(own.select("row", "head", "tail", "size", F.explode("keys").alias("key")), "key", chunk, bulk)
    key = F.shiftleft(F.shiftleft(F.col("key").cast("long"), 22) + F.col("one"), 22) + F.col("two")
    groups = (
        dealt.select(key.alias("group"), "row", "head", "tail", "size")
        .repartition("group")
        .sortWithinPartitions("group")
    )
    return groups.mapInArrow(_possible_batches(similarity), "a long, b long")


def similar_links(
    numbered: DataFrame, width: int, similarity: float, chunk: int = CHUNK, bulk: int = BULK
) -> DataFrame:
    """Links between rows whose shingles are similar, from a stored table (row, text).

    Rows of equal sets go by the least of them.  Blocks, fingerprints and sizes say which
    rows may be similar; only then do the sets of those rows move, to the rows that chains
    of such pairs lead to.
    """
    summaries = stored(numbered.mapInArrow(_summary_batches(width), SUMMARY), "summaries")
    least = summaries.groupBy("digest").agg(F.min("row").alias("a"), F.count("*").alias("rows"))
    repeated = stored(least.filter("rows > 1").select("digest", "a"), "repeated")
    equal = stored(
        summaries.select("digest", F.col("row").alias("b")).join(repeated, "digest").filter("a != b").select("a", "b"),
        "equal",
    )
    folded = summaries.join(equal.select(F.col("b").alias("row")), "row", "left_anti")
    chained = components(_possible(folded, similarity, chunk, bulk)).toDF("row", "part")
    named = stored(chained.join(summaries.select("row", "head", "tail", "size"), "row"), "named")
    # Stored alone, the numbers are small enough to be sent to the texts, as long as Spark's limit allows.
    wanted = stored(named.select("row"), "wanted")
    sets = numbered.join(wanted, "row", "left_semi").mapInArrow(_set_batches(width), "row long, shingles binary")
    similar = (
        _paired(named, "part", chunk, bulk)
        .join(sets, "row")
        .groupBy("part", "one", "two")
        .agg(F.collect_list(F.struct("row", "head", "tail", "shingles")).alias("group"))
        .select("group")
        .mapInArrow(_similar_batches(similarity), "a long, b long")
    )
    return equal.unionByName(similar)


def drop_near_copies(
    docs: DataFrame,
    chunk: int = CHUNK,
    width: int = SHINGLE_WORDS,
    similarity: float | None = None,
) -> DataFrame:
    """One document of each component, the one with the least doc_id, with all its columns.

    Components are of rows whose sets of shingles of ``width`` words are similar; without
    a similarity they are those of fingerprints within MAX_BITS.  Rows go by a stored
    number: rows without an id come last in a component, and exactly one row stays.
    """
    own = fresh(docs, "own_row")
    numbered = stored(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(F.col(own).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = numbered.select(F.col(own).alias("node"), F.col("doc_id").cast("long").alias("doc_id"))
    if similarity is None:
        prints = fingerprints(rows.withColumnRenamed("row", "doc_id"), width)
        least = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
        same = prints.join(least, "fingerprint").select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
        rows_of = [least.toDF(end, f"row_{end}") for end in "ab"]
        near = close_links(least, chunk).join(rows_of[0], "a").join(rows_of[1], "b")
        links = same.unionByName(near.select(F.col("row_a").alias("a"), F.col("row_b").alias("b")))
    else:
        links = similar_links(rows, width, similarity, chunk)
    roots = stored(components(links), "roots")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node"))
    kept = roots.join(ids, "node").groupBy("root").agg(first.alias("kept"))
    dropped = roots.join(kept, "root").filter(F.col("node") != F.col("kept.node"))
    # Stored, the table's size is known, and Spark broadcasts it only below its limit.
    gone = stored(dropped.select(F.col("node").alias(own)), "dropped")
    return numbered.join(gone, own, "left_anti").select(docs.columns)
