"""BPE, decontamination, language, resampling, LM scores, pseudonyms and toxicity."""

from types import SimpleNamespace
import random
import time
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripmart.llm import bpe, decontaminate, language, private, pseudolm, resample, toxicity

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score double, llm_score double"
PATH = public_tokenizers.path("word_bpe_49k.json")


def table(spark, texts):
    return spark.createDataFrame([(i, text, "x", 0.0, None) for i, text in texts], SCHEMA)


ODD = [(1, None), (2, ""), (3, " \n\t"), (None, "word"), (5, "same text"), (5, "same text"),
       (6, "long " * 30_000), (7, "12 !! 3"), (8, "a")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def bpe_texts():
    rng = random.Random(3)
    ranges = [(32, 126), (160, 591), (880, 1535), (9, 32), (1536, 12_543), (127_744, 128_767)]
    mixed = [
        "".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(1, 25)))
        for _ in range(400)
    ]
    return mixed + ["", "aaaa aaaaaaa", "It'll <|endoftext|> DON'T <|startoftext|>x", "ΣΑΣ", "é İ"]


def test_bpe_equals_the_library():
    texts = bpe_texts()
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    own = bpe.encode_texts(texts, bpe.load_tables(PATH))
    for text, (ids, decoded) in zip(texts, own, strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == expected
        assert decoded == library.decode(expected, skip_special_tokens=False)


def test_bpe_of_a_rank_order_that_turns_back():
    """Merges whose product belongs to a merge of lower rank are taken one by one."""
    tables = bpe.load_tables(PATH)
    every = frozenset(range(len(tables.product)))
    texts = ["banana bandana", "mississippi aaaaaa", "internationalisation"]
    slow = bpe.Tables(**{**tables.__dict__, "unordered": every})
    assert bpe.encode_texts(texts, slow) == bpe.encode_texts(texts, tables)


def test_bpe_rows(spark):
    rows = bpe.encoded(table(spark, ODD), PATH, with_tokens=True).collect()
    assert len(rows) == len(ODD)
    assert {row.n_tokens for row in rows if row.doc_id in (1, 2, 3)} == {0}
    assert all(len(row.ids) == row.n_tokens for row in rows)


def dice(a, b, weight):
    shared = sum(min(a[s], b[s]) * weight(s) for s in a)
    return 2 * shared / sum(n * weight(s) for bag in (a, b) for s, n in bag.items())


def test_leaks_against_all_windows(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, draw(rng.choice([3, 12, 25, 25, 40]))) for k in range(12)]
    texts = []
    for k in range(60):
        item = list(rng.choice(items)[1])
        if k % 3 == 1 and len(item) > 20:
            item[rng.randrange(len(item))] = "changed"
        body = item if k % 2 else []
        texts.append((k, " ".join(draw(rng.randint(0, 40)) + body + draw(30)).title()))
    benchmark = spark.createDataFrame(
        [(i, " ".join(item)) for i, item in items] + [(90, None), (91, ""), (None, "x y z")],
        "item_id long, text string",
    )
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(table(spark, texts), benchmark).collect()}
    index = next(decontaminate.indexes(benchmark))
    hashes = decontaminate.WordHashes()
    expected = {}
    for doc_id, text in texts:
        own = hashes.of(text)
        for group in index.groups:
            width = min(index.width, group.size)
            for start in range(len(own) - group.size + 1):
                bag = decontaminate.Counter(
                    decontaminate.shingles(own[start : start + group.size], width).tolist()
                )
                for item_id, item in zip(group.ids, group.bags, strict=True):
                    score = dice(item, bag, index.weight)
                    if score >= decontaminate.SIMILARITY:
                        key = doc_id, item_id
                        expected[key] = max(score, expected.get(key, 0))
    assert got.keys() == expected.keys() and len(expected) > 10
    assert all(abs(got[key] - expected[key]) < 1e-9 for key in got)


def test_leaks_of_odd_texts(spark):
    benchmark = spark.createDataFrame([(1, "same text"), (2, None)], "item_id long, text string")
    docs = table(spark, ODD)
    assert sorted(r.doc_id for r in decontaminate.leaks(docs, benchmark).collect()) == [5, 5]
    assert decontaminate.drop_leaks(docs, benchmark).count() == len(ODD) - 2
    empty = benchmark.limit(0)
    assert decontaminate.leaks(docs, empty).count() == 0


def test_slices_of_the_benchmark_hold_every_item(spark):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    whole = [i for index in decontaminate.indexes(benchmark) for g in index.groups for i in g.ids]
    parts = [i for index in decontaminate.indexes(benchmark, 1000) for g in index.groups for i in g.ids]
    assert sorted(whole) == sorted(parts) and len(whole) == benchmark.count()


def test_leaks_do_not_depend_on_slices(spark):
    rng = random.Random(9)
    draw = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    shared = draw(16)
    items = [(k, shared + draw(14)) for k in range(8)]
    texts = []
    for k in range(64):
        item = list(items[k % 8][1])
        item[rng.randrange(30)] = "changed"
        texts.append((k, " ".join(draw(5) + item + draw(5))))
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in items], "item_id long, text string")
    docs = table(spark, texts)
    assert len(list(decontaminate.indexes(benchmark, 200))) > 4
    found = [
        sorted(tuple(r) for r in decontaminate.leaks(docs, benchmark, 0.6, limit).collect())
        for limit in (decontaminate.SLICE_CHARS, 200)
    ]
    key = lambda rows: [(r[0], r[1], round(r[2], 9), *r[3:]) for r in rows]
    assert key(found[0]) == key(found[1]) and len(found[0]) > 10


def test_language_of_held_out_documents(docs):
    model = language.fitted(docs)
    rows = language.languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = rows.filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) > 100
    assert all(0 <= r.score <= 1 for r in held)


def test_language_spans_scripts_and_odd_texts(spark, docs):
    model = language.fitted(docs)
    names = model.languages
    rows = {r.doc_id: r for r in language.languages(table(spark, ODD), model).collect()}
    assert rows[1].lang_pred == rows[7].lang_pred == language.UNKNOWN and rows[7].score == 0
    sample = {r.lang: r.text for r in docs.filter("length(text) between 300 and 2000").collect()}
    mixed = " ".join(" ".join(sample[name].split()[:40]) for name in ("en", "de", "es"))
    [(_, _, spans)] = language.Labeller(model).label([mixed])
    assert [lang for _, _, lang in spans] == ["en", "de", "es"]
    table_of = np.zeros((16, 2), np.float32)
    scripts = np.zeros((len(language.SCRIPT_STARTS), 2), bool)
    scripts[0, 0] = scripts[2, 1] = True
    narrow = language.Model(language.Settings(buckets=16), ["latin", "cyrillic"], table_of, scripts)
    assert [x[0] for x in language.Labeller(narrow).label(["abc def", "привет"])] == ["latin", "cyrillic"]
    assert names == sorted(names)


def test_every_labelled_language_is_learnt(spark):
    rows = [(i, f"common words of one text {i}", "en") for i in range(3000)]
    rows += [(3000 + i, f"перо слово мир {i}", f"rare{i % 2}") for i in range(12)]
    rows += [(4000, "long " * 20, "long")]
    table_of = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    settings = language.Settings(sample_rows=8, buckets=256)
    assert language.fitted(table_of, settings, None).languages == ["en", "long", "rare0", "rare1"]
    known = table_of.select("doc_id", "lang")
    sizes = {r.lang: r["count"] for r in language._chosen(known, 5).groupBy("lang").count().collect()}
    assert sizes == {"en": 5, "long": 1, "rare0": 5, "rare1": 5}


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([4, 0, 6, 1])
    scores = rng.normal(0, 3, (lengths.sum(), 3)).astype(np.float32)
    path = language.viterbi(scores, lengths, 2.0)
    at = 0
    for n in lengths:
        own = scores[at : at + n]
        value = lambda p: sum(own[t, k] for t, k in enumerate(p)) - 2 * np.count_nonzero(np.diff(p))  # noqa: E731, B023
        best = max((value(p) for p in np.ndindex(*[3] * n)), default=0)
        assert abs(value(path[at : at + n]) - best) < 1e-4 if n else True
        at += n


def test_more_languages_than_a_byte_or_a_list_holds():
    scores = np.zeros((6, 300), np.float32)
    scores[:3, 200], scores[3:, 299] = 9, 9
    assert language.viterbi(scores, np.array([6]), 2.0).tolist() == [200] * 3 + [299] * 3
    names = [f"l{k:02}" for k in range(40)]
    words = [np.array([k + 1], np.uint32) for k in range(40)]
    found, table_of = toxicity._language_tables(words, names, toxicity.Settings(buckets=64))
    assert found == names and [int(table_of[k + 1].argmax()) for k in range(40)] == list(range(40))


def test_resampling(spark, docs, labels):
    rows = resample.resampled(docs, labels).collect()
    count = round(len(rows) * resample.good_share(labels))
    assert sum(r.selected for r in rows) == count
    assert min(r.key for r in rows if r.selected) >= max(r.key for r in rows if not r.selected) - 1e-5
    chosen = {r.doc_id for r in rows if r.selected}
    known = labels.collect()
    good = [r.doc_id in chosen for r in known if r.quality == 1]
    junk = [r.doc_id in chosen for r in known if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(junk) < 0.2


def test_resampling_of_ties_and_no_labels(spark, labels):
    docs = table(spark, [(7, "a")] * 9 + ODD)
    for count in (0, 4, 12, 18):
        rows = resample.resampled(docs, labels.limit(0), count).collect()
        assert sum(r.selected for r in rows) == count
    assert resample.resampled(docs.limit(0), labels).count() == 0


def test_lm_learns_word_order(docs):
    settings = pseudolm.Settings()
    counts = pseudolm.word_counts(docs, settings)
    words = pseudolm.vocabulary(counts, settings)
    plain = pseudolm.Counter(
        w for r in docs.collect() for w in pseudolm.WORD.findall((r.text or "").lower())
    )
    assert {r.word: r.n for r in counts.collect()} == plain
    assert words == sorted(plain, key=lambda w: (-plain[w], w))[: settings.other]
    letters = pseudolm.spelling(counts, words)
    lines = pseudolm.encoded(docs, words, settings, letters)
    network = pseudolm.trained(lines, settings)
    line = pseudolm.Numbers(words, settings, letters).of([" ".join(r.text for r in docs.limit(50).collect())])[0][0]
    mixed = np.array(random.Random(4).sample(line.tolist(), len(line)))
    value = [network.log_probabilities(*network.windows([x])).mean() for x in (line, mixed)]
    assert value[0] > value[1]
    assert value[0] > -np.log(settings.size)


def test_lm_probabilities_sum_to_one():
    settings = pseudolm.Settings(classes=3, per_class=4, shared=2)
    network = pseudolm.new_network(settings)
    around = np.array([[1], [2], [5], [12]]).repeat(12, axis=1)
    total = np.exp(network.log_probabilities(np.arange(12), around)).sum()
    assert abs(total - 1) < 1e-5


def test_lm_probabilities_equal_a_plain_loop():
    settings = pseudolm.Settings(classes=3, per_class=4, shared=3, hidden=5, batch=7)
    network = pseudolm.new_network(settings)
    lines = [np.array([0, 9, 3, 11, 10, 2, 2]), np.array([], int), np.array([8]), np.arange(12)]

    def share(logits, k):
        return logits[k] - np.log(np.exp(logits).sum())

    expected = []
    for line in lines:
        for at, token in enumerate(np.minimum(line, settings.other)):
            total = network.bias.astype(float)
            for table, step in zip(network.near, settings.places, strict=True):
                inside = 0 <= at + step < len(line)
                total = total + table[line[at + step] if inside else settings.size]
            own, within = divmod(int(token), settings.per_class)
            hidden = np.tanh(total)
            first = share(hidden @ network.to_class + network.class_bias, own)
            expected.append(first + share(hidden @ network.to_word[own] + network.word_bias[own], within))
    found = network.log_probabilities(*network.windows(lines))
    assert np.allclose(found, expected, atol=1e-5)


def test_lm_step_follows_the_slope():
    """Small steps against the slope raise the likelihood of their own batch."""
    settings = pseudolm.Settings(classes=3, per_class=4, shared=2, hidden=5, step=0.01)
    network = pseudolm.new_network(settings)
    tokens, around = network.windows([np.random.default_rng(1).integers(0, 12, 300)])
    before = network.log_probabilities(tokens, around).mean()
    for _ in range(20):
        network.learn(tokens, around)
    assert network.log_probabilities(tokens, around).mean() > before


def test_lm_spells_other_words(spark):
    """The bytes after every context are a distribution; a spelling seen often is likelier."""
    rows = [("the", 50), ("tionou", 9), ("tionen", 8), ("\u00e9t\u00e9", 1)]
    counts = spark.createDataFrame(rows, "word string, n long")
    letters = pseudolm.spelling(counts, ["the"])
    sums = np.exp(letters.astype(float)).reshape(-1, 256).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-4)
    numbers = pseudolm.Numbers(["the"], pseudolm.Settings(), letters)
    own = numbers.spell(["tionou", "oitnuo", "\u00e9"])
    assert own[0] > own[1]

    def plain(word):
        line = [pseudolm.START] * 2 + list(word.encode()) + [pseudolm.END]
        contexts = [pseudolm._context(a, b) for a, b in zip(line, line[1:])]
        return sum(letters[c * 256 + byte] for c, byte in zip(contexts, line[2:]))

    assert np.allclose(own, [plain(word) for word in ("tionou", "oitnuo", "\u00e9")])
    lines, spelt = numbers.of(["the tionou oitnuo the", "", "tionou the"])
    assert lines[0][0] == lines[0][3] == 0 and min(lines[0][1:3]) >= numbers.settings.other
    assert np.allclose(spelt, [own[0] + own[1], 0, own[0]])


@pytest.fixture(scope="module")
def lm_scores(docs):
    settings = pseudolm.Settings(shard_tokens=60_000)
    return lambda parts: {
        (r.doc_id, r.n_tokens): r.log_likelihood
        for r in pseudolm.document_scores(docs.repartition(parts), settings).collect()
    }


def test_lm_scores_do_not_depend_on_partitions(lm_scores):
    one = lm_scores(1)
    for parts in (4, 16):
        other = lm_scores(parts)
        assert one.keys() == other.keys()
        assert all(np.isclose(one[key], other[key], rtol=1e-5) for key in one)


def test_lm_of_odd_texts(spark):
    rows = pseudolm.document_scores(table(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    assert all(r.mean_log_likelihood is None and r.log_likelihood == 0 for r in rows if not r.n_tokens)
    assert sorted(r.n_tokens for r in rows if r.doc_id in (2, 5, 6, 7)) == [0, 2, 2, 4, 30_000]
    assert pseudolm.document_scores(table(spark, [])).count() == 0


VALUES = {
    "mail a.b-C9@mail.example.com x": r"mail [a-z]\.[a-z]-[A-Z][0-9]@mail\.example\.com x",
    "ip 10.0.0.255, 300.1.1.1": r"ip \d+\.\d+\.\d+\.\d+, 300\.1\.1\.1",
    "2024-02-29, 29/02/2024, 12/31/1999, 2024-02-30": r"\d{4}-\d\d-\d\d, \d\d/\d\d/\d{4}, \d\d/\d\d/\d{4}, 2024-02-30",
    "ssn 123-45-6789 666-12-1234": r"ssn \d{3}-\d\d-\d{4} 666-12-1234",
    "+1 (743) 555-3824 743-555-3824 +44 20 7946 0958": r"\+1 \((\d{3})\) (\d{3}-\d{4}) \1-\2 \+44 \d\d \d{4} \d{4}",
    "4111 1111 1111 1111 4111111111111112": r"4\d{3} \d{4} \d{4} \d{4} 4111111111111112",
    "GB82 WEST 1234 5698 7654 32": r"GB\d\d WEST \d{4} \d{4} \d{4} \d\d",
}


def test_pseudonyms_keep_format_and_come_back(spark):
    import re

    texts = [*VALUES, "none", "", None, "x" * 100_000, "1" * 5000]
    docs = table(spark, list(enumerate(texts)))
    new = private.pseudonymised(docs, "key")
    rows = {r.doc_id: r.text for r in new.collect()}
    for k, (text, pattern) in enumerate(VALUES.items()):
        assert re.fullmatch(pattern, rows[k]) and rows[k] != text
    back = {r.doc_id: r.text for r in private.pseudonymised(new, "key", undo=True).collect()}
    assert back == dict(enumerate(texts))
    other = {r.doc_id: r.text for r in private.pseudonymised(docs, "other").collect()}
    assert all(other[k] != rows[k] for k in range(len(VALUES)))


def test_dates_of_every_layout_are_permuted(spark):
    from datetime import date, timedelta

    from pyspark.sql import functions as F

    days = [date(1900, 1, 1) + timedelta(k) for k in range(73_049)]
    assert days[-1] == date(2099, 12, 31)
    values = [f"{d:%Y-%m-%d}" for d in days]
    values += [f"{d:%d/%m/%Y}" for d in days] + [f"{d.day}.{d.month}.{d.year}" for d in days]
    values += [f"{d:%m/%d/%Y}" for d in days if d.day > 12]
    values += [f"{d.month}/{d.day}/{d.year}" for d in days if d.day > 12]
    values += [f"{d:%d}/{d.month}/{d.year}" for d in days if d.day < 10 > d.month]
    frame = spark.createDataFrame([(v,) for v in dict.fromkeys(values)], "value string").repartition(8)
    new = frame.select("value", private._date(F.col("value"), "k", False).alias("new"))
    rows = new.select("value", "new", private._date(F.col("new"), "k", True).alias("back")).collect()
    assert all(r.back == r.value for r in rows)
    assert len({r.new for r in rows}) == len(rows)
    form = lambda v: [(len(p), c) for p, c in zip(re.split("[-/.]", v), re.findall("[-/.]", v) + [""])]
    assert all(form(r.new) == form(r.value) for r in rows)
    us = {r.value: r.new for r in rows if "/" in r.value and int(r.value.split("/")[1]) > 12}
    assert us and all(int(new.split("/")[1]) > 12 for new in us.values())


def test_feistel_is_a_permutation(spark):
    from pyspark.sql import functions as F

    days = spark.range(private.DAYS[0] * private.DAYS[1])
    new = days.select(private.feistel(F.col("id"), *private.DAYS, F.lit("date"), "k").alias("x"))
    assert new.distinct().count() == days.count()
    assert new.agg(F.max("x")).first()[0] == days.count() - 1


def test_pseudonyms_run_without_python(spark, docs):
    plan = private.pseudonymised(docs, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_toxicity_ranks_held_out_documents(docs, labels):
    model = toxicity.fitted(docs, labels)
    rows = toxicity.toxicity_scores(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic = [r.score for r in rows if r.toxic == 1]
    clean = [r.score for r in rows if r.toxic == 0]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.85
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.08
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_of_odd_texts_and_labels(spark, docs, labels):
    odd = table(spark, ODD)
    model = toxicity.fitted(odd, labels.limit(0))
    assert toxicity.toxicity_scores(odd, model).count() == len(ODD)
    kept = toxicity.drop_toxic(odd, model)
    assert kept.count() == len(ODD) and kept.columns == odd.columns
    one_kind = toxicity.fitted(docs, labels.filter("toxic = 0"))
    assert toxicity.drop_toxic(docs, one_kind).count() == docs.count()


def test_nothing_else_imports_the_text_operators():
    root = Path(__file__).resolve().parents[2]
    for path in (root / "tripmart").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()


def test_numerals_are_no_letters(spark):
    sample = [(k, f"the word {k} and the house of it", "en") for k in range(1, 60)]
    sample += [(k, f"und das Haus {k} der Wörter ist", "de") for k in range(60, 120)]
    asked = [(1000, "½ ① ² Ⅷ", None), (1001, "12 3.5 ٣", None), (1002, "", None), (1003, "Ⅷ haus", None)]
    docs = spark.createDataFrame(sample + asked, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.languages(docs, language.fitted(docs)).collect()}
    assert [found[k] for k in (1000, 1001, 1002)] == ["und"] * 3
    assert found[1003] == "de"


def test_labelled_texts_are_learnt_whole():
    """A word beyond any prefix decides."""
    rows = [("x " * 60_000 + "zebra", "aa"), ("x " * 60_000 + "quagga", "bb")] * 20
    model = language.train(iter([SimpleNamespace(text=t, lang=lang) for t, lang in rows]), language.Settings())
    labeller = language.Labeller(model)
    assert [one[0] for one in labeller.label(["zebra", "quagga"])] == ["aa", "bb"]


def test_index_of_many_items_and_a_long_text():
    """Time and memory follow the items and stretches; a stretch's border hides nothing."""
    rng = np.random.default_rng(9)
    lines = rng.integers(0, 5_000, (20_000, 14))
    items = [(k, " ".join(f"w{x}" for x in line)) for k, line in enumerate(lines)]
    begun = time.monotonic()
    index = decontaminate.Index(items, {})
    assert time.monotonic() - begun < 60  # takes about two seconds
    step = decontaminate.HELD_WINDOWS
    text = [f"x{k % 9_973}" for k in range(3 * step)]
    planted = {7: 0, 11: step - 7, 12: 2 * step - 1, 19_999: 3 * step - 14, 500: step + 40}
    for item, at in planted.items():
        text[at : at + 14] = items[item][1].split()
    found = index.search(decontaminate.WordHashes().of(" ".join(text)), 0.8)
    assert planted.keys() == found.keys()
    assert all(found[k][0] > 0.999 and found[k][1] == at for k, at in planted.items())


def test_addresses_keep_their_spelling(spark):
    """Leading zeros stay, no two spellings share a pseudonym, and the key undoes it."""
    rng = random.Random(6)
    spelt = {".".join(rng.choice(["", "0", "00"]) + str(rng.randint(0, 255)) for _ in range(4)) for _ in range(600)}
    known = {x for x in spelt if all(len(o) < 4 for o in x.split("."))}
    known |= {"010.0.0.1", "10.0.0.1", "255.255.255.255", "0.0.0.0"}
    known |= {f"1.2.3.{k}" for k in range(256)}
    docs = table(spark, enumerate(sorted(known)))
    new = private.pseudonymised(docs, "key")
    found = [r.text for r in new.orderBy("doc_id").collect()]
    assert len(set(found)) == len(known)
    for old, own in zip(sorted(known), found, strict=True):
        pairs = list(zip(old.split("."), own.split("."), strict=True))
        assert all(len(a) == len(b) and int(b) <= 255 for a, b in pairs)
        assert all((len(a) > 1 and a[0] == "0") == (len(b) > 1 and b[0] == "0") for a, b in pairs)
    back = private.pseudonymised(new, "key", undo=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == sorted(known)
