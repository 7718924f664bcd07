"""Exact, SimHash and suffix dedup against brute force on small tables."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tripmart.llm import exact, simhash, suffixes
from tripmart.llm.components import components

SCHEMA = "doc_id long, text string, digest string, row long, own_key string"


def table(spark, texts):
    """Documents with columns whose names clash with the operators' own."""
    rows = [(i, text, "x", 0, "y") for i, text in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, count):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(count))


def corpus(seed=4):
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(60)]
    passage = words(rng, 60)
    texts += [f"{words(rng, 5)} {passage} {words(rng, 5)}" for _ in range(25)]
    for k in range(20):
        changed = texts[k].split(" ")
        changed[rng.randrange(len(changed))] = "zz"
        texts.append(" ".join(changed))
    texts += [texts[0].upper(), texts[1], texts[1], "", None, " \n", "a" * 700, "ab " * 300, "é" * 150]
    return list(enumerate(texts)) + [(None, texts[2]), (3, texts[3]), (None, None)]


def lowered(text):
    return (text or "").translate(str.maketrans(exact.UPPER, exact.UPPER.lower()))


@pytest.mark.parametrize("counters", [2, 1024])
def test_exact_groups(spark, counters):
    texts = corpus()
    got = exact.exact_groups(table(spark, texts), counters).collect()
    groups = {}
    for doc_id, text in texts:
        groups.setdefault(hashlib.sha256(lowered(text).encode()).digest(), []).append(doc_id)
    assert len(got) == len(texts)
    for row in got:
        ids = groups[bytes(row.digest)]
        assert row.group_size == len(ids)
        assert row.keep_id == max((i for i in ids if i is not None), default=None)
    kept = Counter(bytes(row.digest) for row in got if row.kept)
    assert kept == dict.fromkeys(groups, 1)


def test_drop_copies_keeps_columns_and_one_row(spark):
    docs = table(spark, corpus())
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {row.own_key for row in rows} == {"y"}
    texts = [lowered(row.text) for row in rows]
    assert sorted(texts) == sorted({lowered(text) for _, text in corpus()})


def test_misra_gries_names_every_frequent_digest(spark):
    rng = random.Random(1)
    values = [b"hot"] * 400 + [bytes([rng.randrange(256), rng.randrange(256)]) for _ in range(600)]
    rng.shuffle(values)
    rows = spark.createDataFrame(
        [(i, bytearray(v), i) for i, v in enumerate(values)], "doc_id long, digest binary, row long"
    ).repartition(5)
    winners = exact.heavy_winners(rows, 9).collect()
    assert len(winners) <= 10
    assert {bytes(w.digest): w.group_size for w in winners}[b"hot"] == 400


def plain_fingerprint(text):
    parts = lowered(text).encode().split()
    runs = [b" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))] if parts else []
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(texts):
    prints = [plain_fingerprint(text) for _, text in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    members = {}
    for i, (doc_id, _) in enumerate(texts):
        members.setdefault(root(i), []).append(doc_id)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return sorted(
        ((doc_id, prints[i], least[root(i)]) for i, (doc_id, _) in enumerate(texts)), key=str
    )


@pytest.mark.parametrize("chunk", [2, 2048])
def test_near_components(spark, chunk):
    texts = corpus()
    got = simhash.near_components(table(spark, texts), chunk).collect()
    rows = [(r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in got]
    assert sorted(rows, key=str) == plain_components(texts)


def test_close_links_lose_no_component(spark):
    """Dense fingerprints, so that keys are split into pairs of chunks."""
    rng = random.Random(8)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(150):
        value = base
        for _ in range(rng.randint(0, 6)):
            value ^= 1 << rng.randrange(64)
        prints.add(value)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for chunk in (8, 2048):
        found = components(simhash.close_links(frame, chunk)).collect()
        root = {row.node: row.root for row in found}
        for i, a in enumerate(signed):
            for b in signed[:i]:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                    assert root[a] == root[b]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100)], "a long, b long")
    roots = {row.node: row.root for row in components(links).collect()}
    assert roots == dict.fromkeys(range(61), 0)


def test_drop_near_copies_keeps_one(spark):
    docs = table(spark, corpus()[:100])
    kept = {row.doc_id for row in simhash.drop_near_copies(docs).collect()}
    assert kept == {component for _, _, component in plain_components(corpus()[:100])}


def plain_shingles(text, width=5):
    parts = lowered(text).split()
    return {tuple(parts[i : i + width]) for i in range(max(1, len(parts) - width + 1))} if parts else set()


@pytest.mark.parametrize("chunk", [2, 2048])
def test_drop_near_copies_by_similarity(spark, chunk):
    """Edits that leave 0.6 to 1 of the five-word shingles, most of them beyond 3 bits."""
    rng = random.Random(12)
    texts = [words(rng, rng.randint(100, 400)).split() for _ in range(40)]
    for k in range(160):
        changed = list(texts[k % 40])
        for _ in range(rng.randint(1, max(1, len(changed) // 30))):
            changed[rng.randrange(len(changed))] = "zz"
        texts.append(changed)
    rows = [(i, " ".join(text)) for i, text in enumerate(texts)]
    sets = [plain_shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    beyond = 0
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
                beyond += (plain_fingerprint(rows[i][1]) ^ plain_fingerprint(rows[j][1])).bit_count() > 3
    assert beyond > 50
    kept = simhash.drop_near_copies(table(spark, rows), chunk, width=5, similarity=0.8).collect()
    assert sorted(row.doc_id for row in kept) == [i for i in range(len(rows)) if root(i) == i]


def test_similar_pairs_of_the_documents_are_linked(spark):
    """All pairs of the table at 0.8 or more, by shared shingles, against the links' components."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(row.doc_id, plain_shingles(row.text or "")) for row in docs.collect()]
    used = Counter(shingle for _, own in rows for shingle in own)
    holders, pairs = {}, set()
    for at, (_, own) in enumerate(rows):
        rarest = sorted(own, key=lambda shingle: (used[shingle], shingle))
        for shingle in rarest[: len(own) // 5 + 1]:  # a similar pair shares one of these
            for other in holders.setdefault(shingle, []):
                theirs = rows[other][1]
                if len(own & theirs) >= 0.8 * len(own | theirs):
                    pairs.add((other, at))
            holders[shingle].append(at)
    numbered = docs.select(docs.doc_id.alias("row"), docs.text)
    links = simhash.similar_links(numbered, 5, 0.8)
    root = {row.node: row.root for row in components(links).collect()}
    found = sum(root.get(rows[a][0], -1) == root.get(rows[b][0], -2) for a, b in pairs)
    print(f"{found} of {len(pairs)} similar pairs linked")
    assert len(pairs) > 50 and found >= 0.99 * len(pairs)


@pytest.mark.parametrize("bulk", [1000, simhash.BULK])
def test_bulk_of_shingles_splits_a_band(spark, bulk):
    """Sixty versions of a text, all in the same bands or nearly so, in groups cut by shingles."""
    rng = random.Random(9)
    base = words(rng, 300).split()
    rows = []
    for i in range(60):
        own = list(base)
        own[rng.randrange(len(own))] = f"v{i}"
        rows.append((i, " ".join(own)))
    texts = spark.createDataFrame(rows, "row long, text string")
    links = [(row.a, row.b) for row in simhash.similar_links(texts, 5, 0.8, bulk=bulk).collect()]
    root = {row.node: row.root for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert root == dict.fromkeys(range(60), 0)


def wide_pair(rng, size, similarity):
    """Wide fingerprints of two sorted sets of a similarity, each of this many numbers."""
    shared = round(2 * similarity / (1 + similarity) * size)
    numbers = rng.integers(0, 1 << 63, 2 * size - shared, np.uint64) * np.uint64(2)
    return [simhash.wide_bits(np.sort(own)) for own in (numbers[:size], numbers[size - shared :])]


@pytest.mark.parametrize("size", [9, 90, 900])
def test_candidates_agree_in_a_simhash_block(size):
    """Recall of the candidates at a similarity of 0.8, and how few others agree and are near."""
    rng = np.random.default_rng(size)
    found = {0.8: 0, 0.0: 0}
    for similarity in found:
        for _ in range(500):
            one, two = wide_pair(rng, size, similarity)
            agree = np.any(simhash.block_keys(one) == simhash.block_keys(two))
            found[similarity] += bool(agree) and (one[:128] != two[:128]).sum() <= simhash.SIMILAR_BITS
    print(found)
    assert found[0.8] >= 0.99 * 500 and found[0.0] == 0


def test_less_bits_than_blocks_leave_a_block():
    rng = np.random.default_rng(6)
    bits = simhash.wide_bits(np.sort(rng.integers(0, 1 << 63, 300, np.uint64)))
    for _ in range(200):
        other = bits.copy()
        other[rng.choice(len(bits), simhash.BLOCKS - 1, replace=False)] ^= True
        assert np.any(simhash.block_keys(bits) == simhash.block_keys(other))


def test_wide_bits_are_a_simhash():
    """Against sums one by one; where just half the bits are set, the least number decides."""
    rng = np.random.default_rng(7)
    for size in (1, 2, 7, 600):
        hashes = np.sort(rng.integers(0, 1 << 63, size, np.uint64))
        rows = []
        for value in hashes.tolist():
            words = [value * int(odd) % 2**64 >> 32 for odd in simhash._ODD]
            rows.append([int(bit) for word in words for bit in f"{word:032b}"])
        sums = [sum(column) for column in zip(*rows, strict=True)]
        expected = [2 * n > size or 2 * n == size and least for n, least in zip(sums, rows[0], strict=True)]
        assert simhash.wide_bits(hashes).tolist() == [bool(bit) for bit in expected]
    assert not simhash.wide_bits(np.empty(0, np.uint64)).any()


def test_a_set_moves_once(spark, monkeypatch):
    """Versions of a text agree in blocks in many ways, yet each row is in one group."""
    tables, write = {}, simhash.stored

    def stored(table, name):
        tables[name] = write(table, name)
        return tables[name]

    monkeypatch.setattr(simhash, "stored", stored)
    rng = random.Random(10)
    base = words(rng, 300).split()
    rows = []
    for i in range(40):
        own = list(base)
        for _ in range(4):
            own[rng.randrange(len(own))] = f"v{i}"
        rows.append((i, " ".join(own)))
    simhash.similar_links(spark.createDataFrame(rows, "row long, text string"), 5, 0.8).collect()
    assert sorted(row.row for row in tables["named"].collect()) == list(range(40))


@pytest.mark.parametrize("by", [{}, {"width": 5, "similarity": 0.8}])
def test_drop_near_copies_keeps_one_row_whatever_the_ids(spark, by):
    rng = random.Random(3)
    a, b, c, clean = (words(rng, 300) for _ in range(4))
    rows = [(None, a), (None, a + " "), (7, b), (7, b + " "), (2, c), (5, c + " "), (5, clean)]
    kept = simhash.drop_near_copies(table(spark, rows), **by).collect()
    found = sorted((str(row.doc_id), row.text.strip()) for row in kept)
    assert found == sorted([("None", a), ("7", b), ("2", c), ("5", clean)])


def plain_repeats(texts, length):
    datas = [(doc_id, (text or "").encode()) for doc_id, text in texts]
    seen = Counter(d[i : i + length] for _, d in datas for i in range(len(d) - length + 1))
    out = []
    for doc_id, data in datas:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot, limit", [(1000, 200_000), (2, 500)])
def test_suffix_dedup(spark, tmp_path, hot, limit):
    path = str(tmp_path / "docs")
    table(spark, corpus()).repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    got = suffixes.without_repeats(docs, 60, gram=20, hot=hot, limit=limit).collect()
    assert sorted(map(tuple, got), key=str) == plain_repeats(corpus(), 60)


def owned(found, length):
    """The anchor of each string's start."""
    strings = [
        (start, place)
        for place, left, right in zip(found[0].tolist(), found[4].tolist(), found[5].tolist(), strict=True)
        for start in range(left, right - length + 1)
    ]
    assert len(dict(strings)) == len(strings)
    return dict(strings)


def test_anchors_of_segments_agree(monkeypatch):
    rng = random.Random(2)
    data = bytes(rng.choice(b"abcdef ") for _ in range(5000))
    whole = owned(suffixes.Finder().find(data), suffixes.LENGTH)
    assert sorted(whole) == list(range(5000 - suffixes.LENGTH + 1))
    monkeypatch.setattr(suffixes, "SEGMENT", 1000)
    assert owned(suffixes.Finder().find(data), suffixes.LENGTH) == whole


def test_equal_strings_have_equal_anchors():
    rng = random.Random(8)
    shared = bytes(rng.choice(b"ab ") for _ in range(900))
    one, two = b"x" * 70 + shared + b"y" * 300, b"abab" * 90 + shared
    first, second = (owned(suffixes.Finder().find(data), suffixes.LENGTH) for data in (one, two))
    for i in range(len(shared) - suffixes.LENGTH + 1):
        assert first[70 + i] - 70 == second[360 + i] - 360


def test_bounded_classes_are_shared_prefixes():
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"ab") for _ in range(80)) for _ in range(30)]
    found = suffixes.repeated_places(pieces, np.zeros(30, int), np.full(30, 10), 8)
    for piece, starts in zip(pieces, found, strict=True):
        expected = [
            i for i in range(73)
            if sum(other[i : i + 8] == piece[i : i + 8] for other in pieces) > 1
        ]
        assert starts.tolist() == expected


def test_empty_tables(spark):
    empty = table(spark, [])
    assert exact.exact_groups(empty).count() == 0
    assert exact.drop_copies(empty).count() == 0
    assert simhash.near_components(empty).count() == 0
    assert suffixes.without_repeats(empty).count() == 0
