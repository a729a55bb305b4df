import hashlib
import math
import random
import re
import time
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from flowsight.llm import bpe, chat, html_text, langid, line_dedup, merges, packing, quality, queries, url_filter
from flowsight.llm.words import Memo, blocks
from tests.conftest import SMALL

DOCS = "doc_id bigint, text string"
WORD = r"[^\x20\x09-\x0D]+"
ODD_TEXTS = [None, "", " \n ", "It's  4²½ good things—日本語 🙂 <|endoftext|>", "a" * 3_000, "\x1c\x85 x y ", "ΑΣ ΣΑΣ İ K"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows_of(df):
    return {row[0]: tuple(row) for row in df.collect()}


# quality


def slow_quality(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed,
    )


def slow_shapes(text, vocabularies):
    """Characters per token, share of byte tokens and entropy by both vocabularies, word by word."""
    pieces, encoding, single = vocabularies
    words = re.findall(WORD, text or "")
    found = []
    for number in (0, 1):
        ids = [i for word in words for i in (pieces.encode(word) if number == 0 else encoding.encode_ordinary(f" {word}"))]
        if not ids:
            found += [0.0, 0.0, 0.0]
            continue
        share = [n / len(ids) for n in Counter(ids).values()]
        parts = sum(pieces.is_byte(i) if number == 0 else i in single for i in ids)
        found += [sum(map(len, words)) / len(ids), parts / len(ids), -sum(p * math.log2(p) for p in share)]
    return found


@pytest.fixture(scope="module")
def vocabularies(reference_encoding):
    ranks = bpe.read_ranks(queries.BYTE_RANKS)
    single = {rank for token, rank in ranks.items() if len(token) == 1 and token[0] >= 0x80}
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_VOCABULARY), reference_encoding, single


def test_quality_equals_brute_force(spark, docs, vocabularies):
    extra = spark.createDataFrame(
        list(enumerate([*ODD_TEXTS, "a b c d e f g h i j " * 3, "x\nx\n x\n\n\n" * 20, "w " * 200_000], 10_000)), DOCS
    )
    both = docs.select("doc_id", "text").unionByName(extra)
    got = rows_of(quality.quality(both, queries.VOCABULARIES))
    for key, text in both.collect():
        assert got[key][1:7] == slow_quality(text), key
        assert got[key][9:15] == pytest.approx(slow_shapes(text, vocabularies), abs=1e-9), key
        # no group of this small table has texts enough for a band
        assert got[key][16] == (not got[key][6]) and got[key][15] == ""
    kept = {row["doc_id"] for row in quality.good_rows(both, queries.VOCABULARIES).collect()}
    assert kept == {key for key, row in got.items() if row[16]}
    assert quality.quality(both.limit(0), queries.VOCABULARIES).count() == 0
    assert quality.good_rows(both.limit(0), queries.VOCABULARIES).columns == both.columns


def slow_bands(rows, least):
    """``low, high`` by group, size and measure from sorted values."""
    groups = defaultdict(list)
    for kind, tokens, failed, shapes in rows:
        if not failed:
            groups[kind, max(1, tokens).bit_length() - 1].append(shapes)
    bands = {}
    for key, found in groups.items():
        if len(found) < least:
            continue
        for place, name in enumerate(quality.SHAPE_NAMES):
            values = sorted(shapes[place] for shapes in found)
            low, high = (values[math.ceil(share * len(values)) - 1] for share in (0.25, 0.75))
            reach = max(4.0 * (high - low), {"ken": 0.2, "are": 0.05, "opy": 0.4}[name[-3:]])
            bands[key, name] = low - reach, high + reach
    return bands


def test_bands_reject_what_lies_far_out(spark, vocabularies):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {row["doc_id"]: row for row in docs.collect()}
    noise = [" ".join(hashlib.sha512(str(i * 9 + n).encode()).hexdigest()[:12] for i in range(50)) for n in range(3)]
    extra = [(-1 - place, text, "en", "s", 0) for place, text in enumerate(noise)]
    got = rows_of(quality.quality(docs.unionByName(spark.createDataFrame(extra, docs.schema)), queries.VOCABULARIES))
    langs = {key: row["lang"] for key, row in texts.items()} | {key: "en" for key in (-1, -2, -3)}
    rows = [(langs[key], row[8], row[6], row[9:15]) for key, row in got.items()]
    bands = slow_bands(rows, quality.BAND_TEXTS)
    assert len(bands) >= 12
    for key, row in got.items():
        kind, size = langs[key], max(1, row[8]).bit_length() - 1
        ends = [bands.get(((kind, size), name), (-math.inf, math.inf)) for name in quality.SHAPE_NAMES]
        outside = [name for name, value, (low, high) in zip(quality.SHAPE_NAMES, row[9:15], ends) if not low <= value <= high]
        assert row[15] == ",".join(outside) and row[16] == (not row[6] and not outside), key
    assert not any(got[key][16] for key in (-1, -2, -3))
    marks = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    sound = [key for key in marks if key in got and not got[key][6]]
    assert sum(got[key][16] for key in sound if marks[key]) >= 0.99 * sum(marks[key] for key in sound)
    assert sum(not got[key][16] for key in sound if not marks[key]) >= 0.2 * sum(not marks[key] for key in sound)


def test_bands_go_by_script_where_no_language_is_stated(spark):
    rows = [(number, f"wort zahl {number} und noch acht andere kleine worte {number * 7}", None if number % 2 else "de", 1) for number in range(260)]
    rows.append((900, "zz" * 30 + " " + " ".join("Ω≈ç√∫˜µ≤≥÷" for _ in range(5)) + " a b c d e f", None, 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, kept int")
    got = rows_of(quality.quality(docs, queries.VOCABULARIES))
    assert {row[7] for row in got.values()} <= {"latin", "greek", "other"}
    assert all(got[number][16] for number in range(260))
    stays = quality.good_rows(docs.withColumnRenamed("kept", "n_tokens"), queries.VOCABULARIES)
    assert stays.columns == ["doc_id", "text", "lang", "n_tokens"]
    assert [quality.script_of(t) for t in ("abc", "где", "αβγ", "日本", "123")] == ["latin", "cyrillic", "greek", "han", "other"]


# language


def test_language_on_held_out_texts(spark, docs):
    got = rows_of(queries.op4_language(spark, "/root/testdata/sf0.01"))
    truth = {row[0]: row for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text").collect()}
    assert set(got) == set(truth)
    for key, row in got.items():
        assert row[1] == (zlib.crc32(str(key).encode()) % 5 == 0) and 0 <= row[3] <= 1
    held = [key for key, row in got.items() if row[1] and truth[key][1] and row[2] != "und"]
    assert sum(got[key][2] == truth[key][1] for key in held) > 0.98 * len(held)


def test_language_of_odd_rows(spark):
    learned = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "de"), ("x y", None)], "text string, lang string"
    )
    model = langid.fit(learned)
    assert model.langs == ["de", "en"]
    asked = spark.createDataFrame([(1, None), (2, "123 ..."), (3, "the dog"), (3, "the dog"), (None, "und die"), (5, "qqqq")], DOCS)
    got = langid.identify(asked.withColumn("score", F.lit("x")), model)
    assert sorted((str(r["doc_id"]), r["lang_pred"]) for r in got.collect()) == [
        ("1", "und"), ("2", "und"), ("3", "en"), ("3", "en"), ("5", model.common), ("None", "de"),
    ]
    nothing = langid.fit(learned.limit(0))
    assert [row["lang_pred"] for row in langid.identify(asked, nothing).collect()] == ["und"] * 6
    assert langid.identify(asked.limit(0), model).count() == 0
    assert langid.known_language(asked, model, 0.5).columns == ["doc_id", "text"]


def slow_ngrams(text):
    spaced = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    dense = [c.isalpha() and any(low <= ord(c) <= high for low, high in langid.UNSPACED) for c in spaced]
    grams = [spaced[i : i + 4] for i in range(len(spaced) - 3) if " " not in spaced[i + 1 : i + 3] and not any(dense[i : i + 4])]
    return grams + [spaced[i : i + 2] for i in range(len(spaced) - 1) if dense[i] and dense[i + 1]]


def slow_languages(learned, texts):
    """``lang, score`` of each text from plain sets of n-grams; none of these texts has so many that one must be left out."""
    counts = defaultdict(Counter)
    for lang, text in learned:
        if lang is not None:
            counts[lang].update(slow_ngrams(text))
    best = Counter()
    for found in counts.values():
        for gram, n in found.items():
            best[gram] = max(best[gram], n / found.total())
    sets = {lang: {g for g, n in found.items() if n / found.total() >= 0.2 * best[g]} for lang, found in counts.items()}
    coverage = {lang: sum(n for g, n in counts[lang].items() if g in own) / counts[lang].total() for lang, own in sets.items()}
    for text in texts:
        grams = slow_ngrams(text)
        shares = {lang: sum(g in own for g in grams) / max(1, len(grams)) / coverage[lang] for lang, own in sets.items()}
        if not any(map(str.isalpha, text or "")):
            yield "und", 0.0
        elif not max(shares.values()):
            yield min(counts, key=lambda lang: (-counts[lang].total(), lang)), 0.0
        else:
            lang = min(shares, key=lambda lang: (-shares[lang], lang))
            yield lang, min(1.0, shares[lang])


def test_language_equals_brute_force(spark, docs):
    rows = docs.select("lang", "text").collect()
    texts = [text for _, text in rows] + ODD_TEXTS + ["qqqq", "the", "x" * 5_000]
    # so many slots that no n-gram is taken for another
    model = langid.fit(docs, langid.Settings(slots_per_key=4_000, model_bytes=1 << 40))
    got = list(zip(*langid.classify(model, texts)))
    for text, found, want in zip(texts, got, slow_languages(rows, texts)):
        assert found[0] == want[0] and found[1] == pytest.approx(want[1], abs=1e-6), text[:80]


def test_filters_return_all_languages_of_an_ngram():
    import numpy as np

    settings_ = langid.Settings(n=3)
    keys = {lang: langid.ngrams([text], 3)[0] for lang, text in (("a", "abcdef"), ("b", "defghi"), ("c", "xyz"))}
    members = [(lang, int(np.int64(key.view(np.int64))), 1) for lang, found in keys.items() for key in found]
    model = langid.build_filters(members, {lang: 10 for lang in keys}, settings_)
    totals, hits = langid.hit_counts(model, ["abcdef", "def", ""])
    assert hits[0][0] == totals[0] and hits[1][0] >= 1 and hits[1][1] >= 1 and totals[2] == 0


def test_two_hundred_languages_fit_the_model(spark):
    rng = random.Random(1)
    rows = []
    for number in range(200):
        letters = "".join(rng.sample("abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîï", 9))
        for _ in range(3):
            rows.append((f"l{number:03d}", " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(80))))
    learned = spark.createDataFrame(rows, "lang string, text string")
    small = langid.Settings(model_bytes=32 << 20)
    model = langid.fit(learned, small)
    assert model.slices.nbytes <= 32 << 20 and len(model.langs) == 200
    found = langid.classify(model, [text for _, text in rows])[0]
    assert sum(lang == want for lang, (want, _) in zip(found, rows)) > 0.97 * len(rows)
    for langs in (1, 4, 100, 1_000):
        settings_ = langid.Settings()
        assert settings_.keys_per_lang(langs) * langs * 16 * -(-langs // 8) <= settings_.model_bytes
    few = langid.fit(learned.unionByName(learned.where("lang = 'l007'")), langid.Settings(most_langs=5))
    assert len(few.langs) == 5 and "l007" in few.langs


def test_texts_of_a_script_without_spaces_are_kept(spark):
    rng = random.Random(3)
    signs = [chr(0x4E00 + number) for number in range(3_000)]
    weights = [1 / (rank + 3) for rank in range(len(signs))]
    draw = lambda n: "".join(rng.choices(signs, weights, k=n))
    rows = [("zh", draw(6_000)) for _ in range(200)] + [("en", " ".join(rng.choices(["the", "cat", "sat", "upon", "mats"], k=300))) for _ in range(20)]
    learned = spark.createDataFrame(rows, "lang string, text string")
    # rows enough for over a million different n-grams, also of two letters at most
    assert len({text[i : i + 4] for lang, text in rows if lang == "zh" for i in range(len(text) - 3)}) > 1_000_000
    model = langid.fit(learned)
    fresh = spark.createDataFrame([(draw(400),) for _ in range(30)], "text string")
    langs, scores = langid.classify(model, [row["text"] for row in fresh.collect()])
    assert set(langs) == {"zh"} and sorted(scores)[2] > 0.3
    assert langid.known_language(fresh, model, 0.3).count() >= 28


# byte pairs


@pytest.fixture(scope="module")
def reference_encoding():
    ranks = bpe.read_ranks(queries.BYTE_RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library(spark, docs, reference_encoding):
    extra = spark.createDataFrame(list(enumerate(ODD_TEXTS, 10_000)), DOCS)
    both = docs.select("doc_id", "text").unionByName(extra)
    ids = bpe.encode(both, queries.BYTE_RANKS, public_tokenizers.PATTERN)
    one_pass = bpe.digests(bpe.encode_and_decode(both, queries.BYTE_RANKS, public_tokenizers.PATTERN))
    two_passes = bpe.digests(bpe.decode(ids, queries.BYTE_RANKS, public_tokenizers.PATTERN))
    got = rows_of(one_pass)
    assert got == rows_of(two_passes)
    for key, text in both.collect():
        want = reference_encoding.encode_ordinary(text or "")
        joined = " ".join(map(str, want)).encode()
        assert got[key][1:] == (
            len(want), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        ), key
    assert bpe.encode(both.limit(0), queries.BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aabeinorst'sll \n\t1²éß日🙂\x1c　", max_size=30), max_size=5))
def test_byte_bpe_on_drawn_texts(reference_encoding, texts):
    import numpy as np

    tokens = bpe.byte_tokens(queries.BYTE_RANKS, public_tokenizers.PATTERN)
    got = [np.frombuffer(ids, np.int32).tolist() for ids in tokens.encode(texts)]
    assert got == [reference_encoding.encode_ordinary(text) for text in texts]


@pytest.mark.parametrize("unit", ["a", "=", "ab", "é", "the "[:3]])
def test_one_long_match_takes_seconds(reference_encoding, unit):
    text = unit * (1_000_000 // len(unit))
    started = time.perf_counter()
    (ids,) = bpe.byte_tokens(queries.BYTE_RANKS, public_tokenizers.PATTERN).encode([text])
    (words,) = packing.word_tokens(queries.WORD_VOCABULARY).encode([text])
    assert time.perf_counter() - started < 30
    assert memoryview(ids).cast("i").tolist() == reference_encoding.encode_ordinary(text)
    short = text[:20_000]
    (own,) = packing.word_tokens(queries.WORD_VOCABULARY).encode([short])
    tokenizer = Tokenizer.from_file(queries.WORD_VOCABULARY)
    assert memoryview(own).cast("I").tolist() == tokenizer.encode(short, add_special_tokens=False).ids and len(words) > len(own)


def slow_merges(symbols, ranks, results):
    """The lowest rank first, and of equal ones the first in the word."""
    symbols = list(symbols)
    while True:
        found = [(ranks[pair], place) for place, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
        if not found:
            return symbols
        rank, place = min(found)
        symbols[place : place + 2] = [results[rank]]


@pytest.mark.parametrize("seed", range(40))
def test_merges_of_any_vocabulary(seed):
    """Also of vocabularies in which a merge makes a pair of a lower rank, which trained ones hardly have."""
    import numpy as np

    rng = random.Random(seed)
    letters = rng.randint(1, 4)
    pairs, results, known = [], [], list(range(letters))
    for number in range(rng.randint(1, 14)):
        pair = (rng.choice(known), rng.choice(known))
        if pair not in pairs:
            pairs.append(pair)
            results.append(letters + number)
            known.append(letters + number)
    order = list(range(len(pairs)))
    rng.shuffle(order)
    ranks = {pair: rank for pair, rank in zip(pairs, order)}
    result_of = np.zeros(len(pairs), np.int32)
    result_of[order] = results
    table = merges.MergeTable(np.array(pairs, np.int64), np.array(order, np.int32), np.array(results, np.int32))
    words = [[rng.randrange(letters) for _ in range(rng.randint(0, 40))] for _ in range(30)]
    symbols = np.array([symbol for word in words for symbol in word], np.int32)
    tokens, counts = merges.replay(symbols, np.array([len(word) for word in words]), table)
    edges = np.concatenate([[0], np.cumsum(counts)])
    for number, word in enumerate(words):
        want = slow_merges(word, ranks, result_of.tolist())
        assert tokens[edges[number] : edges[number + 1]].tolist() == want
        assert table.merge_in_turn(word) == want


def test_memo_forgets_and_blocks_cover_everything():
    memo = Memo(lambda words: [word * 2 for word in words], limit=3)
    for start in range(20):
        words = [str(number) for number in range(start, start + 5)]
        table = memo.table(words)
        assert [table[word] for word in words] == [word * 2 for word in words]
        assert len(memo.young) + len(memo.old) <= 16
    assert [list(block) for block in blocks(["aa", "b", "cccc", "", "d"], 3)] == [[0, 1], [2], [3, 4]]
    assert list(blocks([])) == []


# packing


def check_packing(spark, docs, **options):
    tokenizer = Tokenizer.from_file(queries.WORD_VOCABULARY)
    rows = docs.select("doc_id", "text").collect()
    ids = {key: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1] for key, text in rows}
    pieces = packing.pack(docs, queries.WORD_VOCABULARY, **options).collect()
    by_doc, by_sequence = {}, {}
    for piece in pieces:
        own = ids[piece["doc_id"]][piece["start"] : piece["start"] + piece["length"]]
        body = b"".join(number.to_bytes(4, "little") for number in own)
        assert (len(own), zlib.crc32(body), bytes(piece["ids"])) == (piece["length"], piece["ids_crc32"], body)
        assert piece["doc_tokens"] == len(ids[piece["doc_id"]])
        by_doc.setdefault(piece["doc_id"], []).append((piece["start"], piece["length"]))
        by_sequence.setdefault(piece["sequence_id"], []).append((piece["offset"], piece["length"]))
    for spans, total in [(by_doc[key], len(ids[key])) for key in ids]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == total
    lengths = []
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        lengths.append(at)
    assert max(lengths) <= 2048
    return lengths


def test_packing_with_little_memory_gives_the_same_rows(spark, docs):
    chosen = docs.select("doc_id", "text").coalesce(1)
    small = packing.pack(chosen, queries.WORD_VOCABULARY, words=100, rows_at_once=3)
    assert small.collect() == packing.pack(chosen, queries.WORD_VOCABULARY).collect()


def test_packing_of_the_pipeline_remembers_few_words():
    tokens = packing.WordTokens(queries.WORD_VOCABULARY, corpus_pipeline.PACKED_WORDS)
    rows, size = corpus_pipeline.PACKED_ROWS, 100
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = [" ".join(str(row * size + word).translate(letters) for word in range(size)) for row in range(10 * rows)]
    for start in range(0, len(texts), rows):
        assert len([*tokens.encode(texts[start : start + rows])]) == rows
        assert len(tokens.pieces.young) + len(tokens.pieces.old) <= 2 * (corpus_pipeline.PACKED_WORDS + rows * size)


def test_new_words_of_many_texts_are_merged_together():
    tokens = packing.WordTokens(queries.WORD_VOCABULARY, 1_000)
    merged, calls = tokens.pieces.compute, []
    tokens.pieces.compute = lambda pieces: (calls.append(len(pieces)), merged(pieces))[1]
    letters = str.maketrans("0123456789", "abcdefghij")
    # 10 million characters, which went in two parts before; then words that are known, forgotten and new
    rounds = [[f"{'ab ' * 5_000}{number}".translate(letters) for number in range(650)]]
    rounds += [[f"{low + number} {number} é".translate(letters) for number in range(900)] for low in (0, 500, 3_000, 0)]
    for number, texts in enumerate(rounds, 1):
        got = [list(memoryview(ids).cast("I")) for ids in tokens.encode(texts)]
        assert got == [found.ids for found in tokens.whole.encode_batch(texts, add_special_tokens=False)]
        assert len(calls) == number
        assert len(tokens.pieces.young) + len(tokens.pieces.old) <= 2 * (1_000 + 1_801)
    assert calls[0] == 651 and sum(calls) < sum(len(set(" ".join(texts).split())) for texts in rounds)


def test_packing_holds_every_id_once_with_little_padding(spark, docs):
    extra = spark.createDataFrame(list(enumerate([*ODD_TEXTS, "word " * 30_000], 10_000)), DOCS)
    lengths = check_packing(spark, docs.select("doc_id", "text").unionByName(extra))
    padding = sum(2048 - length for length in lengths if length & (length - 1))
    assert padding < 0.02 * sum(lengths)
    empty = docs.limit(0)
    assert packing.pack(empty, queries.WORD_VOCABULARY).count() == 0
    assert check_packing(spark, spark.createDataFrame([(1, None)], DOCS)) == [1]


def test_word_tokens_of_drawn_texts():
    rng, signs = random.Random(4), [*" \n\t aAbÉé'sS1²ªß日🙂\xad\x85İΣσ-,.*", "<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(rng.choice(signs[: rng.randint(8, len(signs))]) for _ in range(rng.randint(0, 30))) for _ in range(3_000)]
    tokens = packing.word_tokens(queries.WORD_VOCABULARY)
    assert [*packing.word_tokens(queries.WORD_VOCABULARY).encode(["a <|endoftext|> b"])] == [array("I", [320, 49407, 321]).tobytes()]
    want = tokens.whole.encode_batch(texts, add_special_tokens=False)
    assert [list(memoryview(ids).cast("I")) for ids in tokens.encode(texts)] == [found.ids for found in want]


def test_differencing_balances_and_counts_rise():
    import numpy as np

    placed = packing.difference(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(placed, weights=[8, 7, 6, 5, 4])) == [14, 16]
    many = np.random.default_rng(2).integers(1, 200, 900)
    sums = np.bincount(packing.difference(many, 40), weights=many)
    assert sums.max() - sums.min() < 5 and sums.sum() == many.sum()
    assert len(set(packing.near_equal_windows(np.array([6, 6, 6]), 10).tolist())) == 3


# chat


def test_chat_round_trip_of_the_table_and_the_hostile_conversation(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    got = rows_of(queries.op3_chat(spark, SMALL))
    want = {}
    rows = sorted([*map(tuple, turns.select("conv_id", "turn", "role", "text").collect()),
                   (-7, 0, "user", queries.HOSTILE), (-7, 1, "assistant", queries.HOSTILE)], key=lambda row: row[:2])
    for conv, _, role, text in rows:
        want.setdefault(conv, []).append((role, text or ""))
    assert set(got) == set(want)
    for conv, own in want.items():
        loss = "".join(text for role, text in own if role == "assistant")
        body = "".join(f"{role}\n{text}\n" for role, text in own)
        digest = [hashlib.sha256(part.encode()).hexdigest() for part in (body, loss)]
        assert got[conv][1:5] == (len(own), digest[0], len(loss), digest[1])
        assert got[conv][5] >= len(loss)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "", "[ROLE]", "tool\\", "[/ROLE]x"]),
    st.lists(st.sampled_from([*chat.INSTRUCT.marks, "\\", "[", "<", "/s>", "INST]", "text", "\n", " "]), max_size=6).map("".join),
), max_size=5))
def test_chat_grammar_reads_back_any_content(turns):
    grammar, text, spans = chat.INSTRUCT, "", []
    for role, content in turns:
        turn, start, end = grammar.settle(role, content)
        spans.append((len(text) + start, len(text) + end))
        text += turn
    at, found = 0, []
    while at < len(text):
        role, content, span, at = grammar.turn_at(text, at)
        found.append((role, content))
        assert span == spans[len(found) - 1]
    assert found == turns


def test_chat_of_odd_rows(spark):
    rows = [(1, None, "user", "b"), (1, 1, None, None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"),
            (None, 0, "user", "x"), (2, 0, "assistant", "<s>" * 50_000)]
    turns = spark.createDataFrame([(*row, 0) for row in rows], f"{chat.TURNS}, formatted int")
    formatted = chat.format_turns(turns)
    got = rows_of(chat.read_back(formatted))
    assert {key: row[1] for key, row in got.items()} == {1: 4, None: 1, 2: 1}
    assert got[1][3] == 2 and got[2][3] == 150_000
    texts = {row["conv_id"]: row for row in chat.conversation_texts(formatted).collect()}
    assert "".join(texts[1]["text"][a:b] for a, b in texts[1]["loss_spans"]) == "aa"
    assert {key: len(row["text"]) for key, row in texts.items()} == {key: row[5] for key, row in got.items()}
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


# lines, addresses, pages


def test_lines_of_odd_rows(spark):
    rows = [(i, "s", f"own {i}\n Menu \n\nMenu\r") for i in range(6)] + [(None, None, "Menu"), (8, "t", None), (9, "t", "Menu")]
    pages = spark.createDataFrame([(*row, 1) for row in rows], "page_id bigint, host string, text string, common int")
    got = {row["page_id"]: row for row in line_dedup.drop_boilerplate(pages, max_ratio=0.5, min_pages=5).collect()}
    assert got[3]["text"] == "own 3\n" and (got[3]["n_lines"], got[3]["n_dropped"]) == (4, 2)
    assert got[None]["text"] == "Menu" and got[9]["text"] == "Menu" and got[8]["text"] == ""
    assert line_dedup.drop_boilerplate(pages.limit(0)).count() == 0


def test_line_dedup_is_native(spark, plan_of):
    assert not re.search("Python|Pandas|Arrow", plan_of(queries.op5_line_dedup(spark, SMALL)))


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/x?q", "https://x.example.com/de/", "http://x.example.com/de", "ftp://m.org/fr/a#b",
            "http://net", "http://net/", None, "no address", "://", "http://xnet/en/", "http://example.net/fr/", "http://org/fr/x/y"]
    pages = spark.createDataFrame([(i, url, "r") for i, url in enumerate(urls)], "page_id bigint, url string, rule string")
    got = rows_of(url_filter.judge_urls(pages, queries.URL_RULES))
    assert [got[i][3] for i in range(len(urls))] == [
        "example.net/en/", "example.com/de/", None, "org/fr/", None, "net/", None, None, None, None, "net/", "org/fr/",
    ]
    assert got[0][1:3] == ("a.example.net", "/en/x") and got[8][1:3] == ("", "")
    assert [got[i][4] for i in (0, 1, 2, 5)] == ["allow", "block", "allow", "block"]
    assert url_filter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b.a", "c.b.a", "b", ""]), st.sampled_from(["/", "/x", "/x/", "/x/y/", ""])), max_size=6, unique=True),
       st.sampled_from(["a", "b.a", "c.b.a", "d.c.b.a", "b", "xa"]), st.sampled_from(["", "/", "/x", "/xy", "/x/", "/x/y", "/x/y/z"]))
def test_trie_equals_a_scan_of_the_rules(pairs, host, path):
    rules = [url_filter.Rule(h + p, url_filter.BLOCK) for h, p in pairs]
    fits = [r for r in rules if ("." + host).endswith("." + r.host if r.host else "") and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host.split(".")) if r.host else 0, len(r.path)), default=None)
    found = url_filter.Trie(rules).longest(host, path)
    assert (found and found.text) == (best and best.text)


PAGES = {
    "a<p>b<p>c": "a\n\nb\n\nc",
    "<ul><li>a<li>b<ol><li>x<li>y</ol><li>c</ul>": "- a\n- b\n\n  1. x\n  2. y\n- c",
    "<table><tr><th>n<th>value<tr><td>long name<td>1</table>": "n         | value\nlong name | 1",
    "<table><tr><td colspan=2>wide<td>c<tr><td>a<td>b<td>c</table>": "wide |   | c\na    | b | c",
    "<table><tr><td rowspan=2>tall<td>x<tr><td>y<tr><td>z</table>": "tall | x\n     | y\nz",
    "<table><tr><td colspan=x>a<td colspan=0>b<td colspan=99999></table>": "a | b",
    "<table><tr><td>" + "w" * 150 + "<td>b<tr><td>a<td>b</table>": "w" * 150 + " | b\na" + " " * 99 + " | b",
    "<div hidden>x</div><span style='display: none'>y</span><script>z</script>seen<!-- c -->": "seen",
    "<head><title>t</title><p>body &amp; soul&nbsp;x": "body & soul\xa0x",
    "<pre> a\n  b</pre>c": " a\n  b\n\nc",
    "one <b>two</b>\n three<br>four": "one two three\nfour",
    "<p>a<div>b</p>c": "a\n\nb\n\nc",
    "": "",
}


@pytest.mark.parametrize("html", PAGES)
def test_visible_text(html):
    assert html_text.visible_text(html) == PAGES[html]


def test_pages_of_odd_rows(spark):
    deep = "<div>" * 20_000 + "deep" + "<ul><li>" * 2_000 + "deeper"
    rows = [(1, None), (2, ""), (2, ""), (None, "<b>x"), (4, deep), (5, "<p>w" * 30_000)]
    pages = spark.createDataFrame([(*row, 0) for row in rows], "page_id bigint, html string, text int")
    got = [tuple(row) for row in html_text.extract(pages).collect()]
    assert len(got) == 6 and (None, "x") in got and got.count((2, "")) == 2 and (1, None) not in got
    found = dict(got)
    assert "deep" in found[4] and "deeper" in found[4] and found[5].count("w") == 30_000
    assert html_text.extract(pages.limit(0)).count() == 0


def test_every_word_of_a_page_is_in_its_text(spark):
    for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        body = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->|<!DOCTYPE[^>]*>", " ", row["html"])
        import html as entities

        words = Counter(re.findall(r"\w+", entities.unescape(re.sub(r"<[^>]*>", " ", body))))
        assert Counter(re.findall(r"\w+", re.sub(r"(?m)^\s*\d+\. ", "", html_text.visible_text(row["html"])))) == words


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<table><tbody><td>x</td></tbody></table>", "x"),
        ("<table><td>x<td>y</table>", "x | y"),
        ("<table><tbody><form><tr><td>a</td></tr><tr><td>b</td></tr></form></tbody></table>z", "a\nb\n\nz"),
        ("<table><tbody>loose <a href=x>link</a><tr><td>a</td></tr></tbody><tbody>more</tbody></table>", "loose link more\na"),
        ("<table><tfoot><div>note</div><tr><th>t</th></tr></tfoot></table>", "note\nt"),
        ("<table><tbody><div>note<tr><td>a<td>b</table>", "note\na | b"),
        ("<table><tbody hidden>gone<td>gone</tbody><tbody><template><tr><td>gone</td></tr></template><tr><td>a</table>", "a"),
        ("<table><tr><td><table><tbody><td>in</table><td>out</table>", "in | out"),
    ],
)
def test_tables_hold_what_is_in_no_row(html, want):
    assert html_text.visible_text(html) == want


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<h1>Hello</h1><ul><li>a</ul><p>x", "Hello\n\n- a\n\nx"), ("<header>top</header><p>x", "top\n\nx"),
        ("<center>c<p>x<div>y</div>", "c\n\nx\n\ny"), ("plain<p>x", "plain\n\nx"), ("<a href=u>link</a> <b>b</b>", "link b"),
        ("<table><tr><td>a</table>x", "a\n\nx"), ("<span>s</span><form>f</form>", "s\nf"), ("<img alt=pic>", "pic"),
    ],
)
def test_head_without_end_hides_no_body(body, want):
    head = "<head><meta charset=u> <link rel=x><title>t</title><style>s</style>\n<script>j</script><noscript>n</noscript>"
    assert html_text.visible_text(head + body) == want
    assert html_text.visible_text(f"<html>{head}</head><body>{body}") == want


@pytest.mark.parametrize("levels", [90, 330, 2_000])
def test_closed_nested_lists_and_tables(levels):
    numbers = [f"n{place}" for place in range(levels)]
    for before, after in (("<ul><li>", "</li></ul>"), ("<table><tbody><tr><td>", "</td></tr></tbody></table>"), ("<ul>", "</ul>")):
        page = "".join(f"{before}{number}" for number in numbers) + after * levels + "<p>end"
        assert re.findall(r"\w+", html_text.visible_text(page)) == [*numbers, "end"]
