"""Packing, SimHash, language, toxicity and pieces against brute force and odd input."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ticketloom.llm import language, packing, pieces, simhash, toxicity
from ticketloom.llm.storage import filter_batches, map_batches

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, score int, length string, part string"
ODD_TEXTS = [
    None, "", " ", "\n\t ", "A.", "naïve café ÉCOLE", "x" * 5000, "word " * 9000, "tab\tand\x0bvt\x1cfs\x85nel\xa0nbsp",
    "<|endoftext|> it's 12 ﬁne\x01mark", "日本語 🎉 z\x00y", "é ́x", "ΑΣ ΣΑΣ", "%%% *** 123", "▁x  ▁▁y",
]


def odd_docs(spark, texts=ODD_TEXTS):
    rows = [(i, text, i, "clash", "clash") for i, text in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no id", 0, None, None)]
    return spark.createDataFrame(rows, DOCS)


def prose(count, seed=0):
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(rng.choice(list("aeinorst"), 5)) for _ in range(300)]
    return [" ".join(rng.choice(vocabulary, rng.integers(1, 200))) for _ in range(count)]


# -- packing ----------------------------------------------------------------------


def expected_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(WORDS)
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[start : start + capacity], "<u4")
            out.append((doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
    return Counter(out)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing_keeps_every_token_and_leaves_no_gap(spark, capacity):
    docs = odd_docs(spark, ODD_TEXTS + prose(60))
    packed = packing.pack(docs, WORDS, capacity, keep_ids=True)
    rows = packed.collect()
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == expected_pieces([(r.doc_id, r.text) for r in docs.collect()], capacity)
    ends = {}
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends.get(row.sequence_id, 0)
        ends[row.sequence_id] = row.offset + row.length
    assert max(ends.values()) <= capacity
    assert len(ends) <= -(-sum(ends.values()) // capacity) + 1
    lengths = {r.sequence_id: len(r.ids) for r in packing.sequences(packed).collect()}
    assert lengths == ends


def test_packing_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), WORDS).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20))
def test_plan_uses_every_piece_once(counts):
    used = Counter()
    for lengths, alike in packing.plan(counts, 40):
        assert sum(lengths) <= 40 and alike > 0
        for length in lengths:
            used[length] += alike
    assert used == Counter(counts)


def test_plan_fills_gaps_exactly_where_lengths_allow():
    assert sum(n for _, n in packing.plan({60: 5, 40: 5}, 100)) == 5
    assert sum(n for _, n in packing.plan({50: 4, 30: 4, 20: 4}, 100)) == 4
    assert sum(n for _, n in packing.plan({40: 3, 30: 3, 20: 3, 10: 3}, 100)) == 3


def test_an_exact_triple_is_found_behind_a_pair_that_is_used_up():
    left = np.zeros(101, dtype=np.int64)
    left[[70, 40, 35, 25, 20]] = 1
    there = left > 0
    assert packing._exact_fill(100, left, there, packing._pair_sums(there, 100), Counter()) == [40, 35, 25]


# -- SimHash ------------------------------------------------------------------------


def slow_fingerprint(text, k=4):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance):
    values = list(prints)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_fingerprints_of_odd_texts():
    for text in ODD_TEXTS + prose(5):
        assert simhash.text_fingerprint(text, 4) == slow_fingerprint(text)


@pytest.mark.parametrize("limit", [4_000_000, 2_000])
def test_linked_fingerprints_are_the_components_within_the_distance(spark, monkeypatch, limit):
    """The smaller limit deals groups of near copies out again by more bits."""
    monkeypatch.setattr(simhash, "VARIANTS_PER_TASK_GROUP", limit)
    rng = np.random.default_rng(3)
    centres = [int(v) for v in rng.integers(0, 1 << 63, 12)]
    prints = {0, (1 << 64) - 1, *centres}
    for centre in centres[:6]:
        value = centre
        for _ in range(12):  # chains: each a few bits from the one before
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                value ^= 1 << int(bit)
            prints.add(value)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in prints}
    table = spark.createDataFrame([(v,) for v in signed.values()], "fingerprint long")
    from ticketloom.llm.components import connected_components

    links = simhash.linked_fingerprints(table, 4)
    found = {r.node: r.root for r in connected_components(links).collect()}
    expected = components(prints, 4)
    groups = {}
    for value in prints:
        groups.setdefault(found.get(signed[value], signed[value]), set()).add(value)
    wanted = {}
    for value in prints:
        wanted.setdefault(expected[value], set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_near_duplicates_of_odd_rows(spark):
    base = prose(12, seed=5)
    texts = ODD_TEXTS + base + [base[0], base[1] + " more", base[0].upper()]
    docs = odd_docs(spark, texts)
    rows = simhash.near_duplicates(docs).collect()
    prints = {r.doc_id: slow_fingerprint(texts[r.doc_id]) for r in rows if r.doc_id is not None}
    group = components(set(prints.values()), 4)
    least = {}
    for doc_id, value in prints.items():
        least[group[value]] = min(least.get(group[value], doc_id), doc_id)
    assert len(rows) == docs.count()
    for row in rows:
        if row.doc_id is not None:
            assert row.fingerprint % (1 << 64) == prints[row.doc_id]
            assert row.component_id == least[group[prints[row.doc_id]]]
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(least.values())
    of_all = components({slow_fingerprint(r.text) for r in docs.collect()}, 4)
    assert kept.count() == len(set(of_all.values()))
    empty = docs.where("false")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.without_near_duplicates(empty).count() == 0


def test_one_row_of_each_group_stays(spark):
    """Null ids, an id with two texts, wholly equal rows, and columns with odd names."""
    one, two, three = prose(3, seed=8)
    rows = [(None, one, 1), (None, one, 2), (None, one, 2), (7, two, 1), (7, three, 1), (8, two, 0), (9, one, 5), (9, one, 5)]
    rows += [(None, "only here", 3)] * 3
    schema = "doc_id long, text string, `_key0` int"
    names = ["doc_id", "text", "_key0", "_same_text", "a.b"]
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "'own' AS _same_text", "map(1, doc_id) AS `a.b`")
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == names
    got = kept.collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(9, one), (7, two), (7, three), (0, "only here")])
    assert {r._same_text for r in got} == {"own"}
    assert simhash.without_near_duplicates(spark.createDataFrame([("a b",), ("a b",)], "text string").selectExpr("*", "1L AS doc_id")).count() == 1


# -- language ------------------------------------------------------------------------


def language_docs(spark):
    rng = np.random.default_rng(1)
    letters = {"aa": "aeioulmn", "bb": "bcdfgaei", "cc": "κλμνξαεο"}
    stems = {k: ["".join(rng.choice(list(v), rng.integers(2, 8))) for _ in range(80)] for k, v in letters.items()}
    rows = []
    for i in range(300):
        lang = list(stems)[i % 3]
        rows.append((i, " ".join(rng.choice(stems[lang], rng.integers(3, 120))), lang))
    rows += [(900, None, "aa"), (901, "123 %%", "bb"), (902, "", None), (903, " ".join(stems["aa"][:9]), None), (None, "bcd fgb", "bb")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_texts(spark):
    docs = language_docs(spark)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = {r.doc_id: r for r in language.identify(docs, language.fit(docs)).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out == (i in held) for i in range(300))
    assert np.mean([found[i].lang_pred == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())
    for i in (900, 901, 902):
        assert (found[i].lang_pred, found[i].score) == ("und", 0)
    assert found[903].lang_pred == "aa"
    kept = language.with_clear_language(docs, language.fit(docs))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {900, 901, 902} and len(ids) >= 300


def test_every_sampled_text_gives_a_share(spark):
    """400 long texts of own words: each is in the dictionary or the primer, repeats once."""
    words = [f"{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(500)]
    rows = [(i, f"{w}qx " * 3000, "aa") for i, w in enumerate(words)] + [(1, "zzqx " * 3000, "aa")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {w for i, w in enumerate(words) if zlib.crc32(str(i).encode()) % 5 != 0} | {"zz"}
    for most in (400, 50):
        content, primer = language.fit(docs, texts_per_language=most)["aa"]
        whole = (content + primer).decode()
        assert len({w for w in learned if w + "qx" in whole}) == min(most, len(learned))
        assert len(whole) <= language.DICTIONARY_BYTES + language.PRIMER_BYTES
    assert language.share_of_each([5, 100, 100], 105) == 50
    assert language.share_of_each([5, 6], 100) == 6


def test_compressed_sizes_are_those_of_plain_zstandard():
    """The classifier against one compressor built anew for every block."""
    rng = random.Random(3)
    sources = {k: (" ".join(rng.choices(v, k=900)).encode(), " ".join(rng.choices(v, k=90)).encode())
               for k, v in {"aa": ["una", "lume", "noi"], "bb": ["bad", "fig", "cab"], "cc": ["una", "bad"]}.items()}
    tool = language.CompressionClassifier(sources)
    for size in (1, 30, 2000, 9000):
        plain = " ".join(rng.choices(["una", "bad", "fig", "noi", "xyz"], k=size))
        sizes = {}
        for lang, (content, primer) in sources.items():
            packed = lambda part: len(language.zstandard.ZstdCompressor(
                level=9, dict_data=language.zstandard.ZstdCompressionDict(content, dict_type=language.zstandard.DICT_TYPE_RAWCONTENT),
                write_content_size=False, write_checksum=False, write_dict_id=False).compress(part))
            text = plain.encode()
            if len(text) < 300:
                sizes[lang] = packed(primer + text) - packed(primer)
            else:
                sizes[lang] = sum(packed(text[at : at + 4000]) for at in range(0, len(text), 4000))
        best, second = sorted(sizes.values())[:2]
        lang, margin = tool.classify(plain)
        assert sizes[lang] == best and margin == pytest.approx(min(1, max(0, (second - best) / max(second, 1))))


def test_languages_without_anything_to_learn(spark):
    docs = language_docs(spark).where("lang is null")
    assert language.fit(docs) == {}
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.identify(docs.where("false"), {}).count() == 0


def test_texts_of_unclear_language_are_rejected(spark):
    same = (b"abc abd " * 200, b"abc abd ")
    docs = spark.createDataFrame([(1, "abc abd abc"), (2, "")], "doc_id long, text string")
    assert language.with_clear_language(docs, {"x": same, "y": same}).count() == 0


# -- toxicity --------------------------------------------------------------------------


def toxic_docs(spark):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("aeinorst"), 6)) for _ in range(400)]
    stems = ["zgugly", "zghateful", "zgvilest"]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(vocabulary, 60))
        toxic = i % 4 == 0
        for at in rng.choice(60, 3) if toxic else ():
            words[at] = rng.choice(stems) + rng.choice(["", "s", "er"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (902, "the zguglyy one"), (None, "no id")]
    labels += [(5, 1), (None, 1)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_toxic_texts_are_found_also_when_misspelled(spark):
    docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, labels, steps=400)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(400) if found[i].held_out]
    assert np.mean([found[i].predicted == int(i % 4 == 0) for i in held]) > 0.95
    assert found[900].score == found[901].score == 0
    assert found[902].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.predicted}


def test_toxic_texts_are_learned_whole(spark):
    words = [f"w{i}x" for i in range(600)]
    rows = [(i, int(i < 3), " ".join(words[: 600 - 100 * i])) for i in range(3)] + [(7, 0, " ".join(words))]
    sample = spark.createDataFrame(rows, "id long, label int, text string")
    bags = toxicity._bags(sample, 40, 1000)
    assert np.bincount(bags.text).tolist() == [150, 125, 100, 38]
    some = toxicity._bags(sample, 40, 230)
    assert {(label, n) for label, n in zip(some.label[np.diff(some.text, prepend=-1) > 0].tolist(), np.bincount(some.text).tolist())} in (
        {(1, 125), (1, 100), (0, 38)}, {(1, 150), (0, 38)},
    )
    assert np.bincount(toxicity._bags(sample, 40, 10).text).tolist() == [100, 38]


def test_windows_are_judged_in_bounded_memory(spark, monkeypatch):
    docs, labels = toxic_docs(spark)
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 80, 100_000)
    sizes[7] = 1_200_000  # more than a stretch
    text = np.arange(len(sizes)) // 100
    grams = rng.integers(0, 1 << toxicity.BUCKET_BITS, sizes.sum(), dtype=np.uint32)
    bags = toxicity.Bags(grams, sizes, text, text % 2)
    logits = rng.normal(0, 1, 1 << toxicity.BUCKET_BITS).astype(np.float32)
    kept = []
    monkeypatch.setattr(toxicity, "_bags", lambda *a: bags)
    monkeypatch.setattr(toxicity, "_train", lambda bags, windows, *a: (kept.append(windows), (logits, 0.5))[1])
    tracemalloc.start()
    toxicity.fit(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * grams.nbytes
    found = np.add.reduceat(logits[grams], bags.starts, dtype=np.float64) / sizes + 0.5
    top = np.maximum.reduceat(found, np.arange(0, len(sizes), 100))[text]
    assert kept[1].tolist() == np.flatnonzero((text % 2 == 0) | (found >= np.minimum(top, np.maximum(0, top / 2)))).tolist()


def test_toxicity_without_labels(spark):
    docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), model).count() == 0


# -- pieces ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def piece_model():
    return pieces.PieceModel(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abet hing  \n\t▁éß日🎉\x00​<s>0x=-_"), max_size=60), max_size=6))
def test_pieces_equal_the_library(piece_model, library, texts):
    got = pieces.PieceEncoder(piece_model).encode(texts)
    assert [ids.tolist() for ids in got] == [library.encode(t, add_eos=True) for t in texts]
    for ids in got:
        assert pieces.decode_ids(piece_model, ids.astype(np.int64)) == library.decode(ids.tolist())


def test_pieces_of_long_and_odd_texts(spark, piece_model, library):
    texts = ["a" * 3000, "ab" * 700, " " * 40, "=" * 300, "日本語" * 200, *(t for t in ODD_TEXTS if t), *prose(20)]
    docs = odd_docs(spark, texts + [None])
    rows = pieces.decode(pieces.encode(docs, PIECES), PIECES).collect()
    assert len(rows) == docs.count()
    for row in rows:
        if row.doc_id is not None:
            ids = library.encode((texts + [None])[row.doc_id] or "", add_eos=True)
            assert row.ids == ids and row.text == library.decode(ids)
    assert pieces.decode(pieces.encode(docs.where("false"), PIECES), PIECES).count() == 0


def test_words_kept_give_the_same_ids_as_whole_texts():
    tokenizer = Tokenizer.from_file(WORDS)
    rng = np.random.default_rng(6)
    pool = [chr(c) for c in range(256)] + list("aaaeee   ..,,''12stll") + ["́", "İ", "Σ", "<|endoftext|>", "<|STARTOFTEXT|>", "日", "'s"]
    texts = ["".join(rng.choice(pool, rng.integers(0, 60))) for _ in range(3000)]
    got = list(packing.WordCachingEncoder(WORDS).encode(texts))
    assert [ids.tolist() for ids in got] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_a_known_word_is_not_encoded_again_by_later_tasks(monkeypatch):
    encoder = packing.kept_encoder(WORDS)
    texts = [f"Ünder the {n} bridges, {n} x\tof-(it)" for n in ("old", "new")] + ["it's 日 old", "", "<|endoftext|> it"]
    first = [ids.tolist() for ids in encoder.encode(texts)]
    monkeypatch.setattr(packing.WordCachingEncoder, "_learn", lambda self, words: pytest.fail(f"{words} were known"))
    again = [ids.tolist() for ids in packing.kept_encoder(WORDS).encode(texts[::-1])]
    assert again[::-1] == first
    monkeypatch.undo()
    monkeypatch.setattr(packing, "WORDS_KEPT", 3)
    assert [ids.tolist() for text in texts for ids in encoder.encode([text])] == first


def test_parting_texts_into_words_takes_little_beside_them():
    texts = [b"a" * 2_000_000, b"b" * 2_000_000]
    tracemalloc.start()
    words, counts = packing._words(texts, packing._IN_OTHERS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == [1, 1] and words.to_pylist() == texts
    assert peak < 30_000_000


def test_words_are_runs_of_letters_and_of_others():
    rng = np.random.default_rng(8)
    texts = ["".join(map(chr, rng.integers(0, 256, rng.integers(0, 40)))).replace("'", "").replace("<|", "") for _ in range(2000)]
    coded = [packing._in_latin(text) for text in texts]
    assert packing._in_latin("it's") is packing._in_latin("a<|b") is packing._in_latin("日") is None
    words, counts = packing._words(coded, packing._IN_LATIN)
    expected = []
    for text in texts:
        for space in "\t\n\v\f\r":
            text = text.replace(space, " ")
        expected.append(re.findall("[a-zªµºß-öø-ÿ]+|[^ a-zªµºß-öø-ÿ]+", text.lower()))
    assert [w.decode("latin-1") for w in words.to_pylist()] == sum(expected, [])
    assert counts.tolist() == [len(own) for own in expected]


# -- batches ----------------------------------------------------------------------


def test_a_batch_does_not_grow_with_the_texts_in_it(spark):
    docs = spark.range(0, 600, 1, 1).selectExpr("id", "repeat(cast(id % 10 as string), 20000) text")

    def start():
        return lambda texts: [sum(map(len, texts)) < 4_000_000] * len(texts)

    def begin():
        return lambda ids, texts: {"id": ids, "chars": [sum(map(len, texts))] * len(ids)}

    assert filter_batches(docs, "text", start).count() == 600
    chars = [r.chars for r in map_batches(docs, ["id", "text"], "id long, chars long", begin).collect()]
    assert len(chars) == 600 and max(chars) < 4_000_000
    # A text longer than a batch is still read whole.
    long = spark.createDataFrame([(1, "x" * 9_000_000), (2, None), (3, "y")], "id long, text string").coalesce(1)
    assert filter_batches(long, "text", lambda: lambda texts: [len(t or "") != 1 for t in texts]).count() == 2
