import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowsight.llm import divergence, neighbours, periodic, queries
from tests.conftest import SMALL

DOCS = "doc_id bigint, text string"
WORD = r"[^\x20\x09-\x0D]+"


# periodic runs


def slow_runs(words):
    """All runs by their definition: for every period the longest stretches, the smallest period of each."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end > start:
                length = end + period - start
                if length >= max(6, 4 * period):
                    found.setdefault((start, length), period)
                start = end
            start += 1
    return sorted((start, length, period) for (start, length), period in found.items())


def planted_words(key, text):
    words = re.findall(WORD, text or "")
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def slow_digests(key, words):
    runs = sorted(slow_runs(words), key=lambda run: (run[0], run[2]))
    best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2])) if runs else (None, None, None)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = " ".join(word for i, word in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return (key, len(runs), *best, milli, *(hashlib.sha256(part.encode()).hexdigest() for part in (lines, kept)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(
    st.lists(st.sampled_from([b"a", b"b"]), max_size=40), st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=7),
    st.integers(0, 9), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=10),
).map(lambda x: x[0] + x[1] * x[2] + x[3]), max_size=5))
def test_runs_of_drawn_words(texts):
    got = [[(run.start, run.length, run.period) for run in runs] for runs in periodic.runs_of(texts)]
    assert got == [sorted(slow_runs(words), key=lambda run: (run[0], run[2])) for words in texts]


def test_run_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {row["doc_id"]: tuple(row) for row in queries.op11_periodic_runs(spark, SMALL).collect()}
    assert set(got) == {key for key, _ in docs}
    for key, text in docs:
        words = planted_words(key, text)
        if len(words) < 3_000:
            assert got[key] == slow_digests(key, words)
    assert sum(row[1] > 0 for row in got.values()) > 10


def test_planting_of_odd_rows(spark):
    planted = [key for key in range(200) if zlib.crc32(str(key).encode()) % 10 == 0]
    rows = [(planted[0], None), (planted[1], " \n"), (planted[2], "one"), (planted[3], "a b\tc\x0bd é\x85f\xa0g " * 9), (None, "x y"), (1, "p  q")]
    docs = spark.createDataFrame(rows, DOCS)
    text = periodic.with_planted_runs(F.col("doc_id"), F.col("text"))
    got = {row["doc_id"]: row["planted"] for row in docs.select("doc_id", text.alias("planted")).collect()}
    for key, value in rows:
        assert re.findall(WORD, got[key] or "") == planted_words(key, value)


def test_runs_of_odd_rows(spark):
    long = "z " * 200_000 + "end"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 6), (4, "a " * 6), (None, "a " * 5), (5, long), (6, "x y x y x y x y q")]
    docs = spark.createDataFrame([(*row, 1, "s") for row in rows], f"{DOCS}, runs int, start string")
    got = [(row["doc_id"], row["n_words"], [tuple(run) for run in row["runs"]], row["collapsed"]) for row in periodic.find_runs(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"),
            (None, 5, [], "a a a a a"), (5, 200_001, [(0, 200_000, 1)], "z end"), (6, 9, [(0, 8, 2)], "x y q"),
        ],
        key=str,
    )
    digests = {row["doc_id"]: row for row in periodic.run_digests(periodic.find_runs(docs)).collect()}
    assert digests[5]["exponent_milli"] == 200_000_000 and digests[1]["start"] is None
    assert digests[1]["runs_sha256"] == hashlib.sha256(b"").hexdigest()
    assert periodic.run_digests(periodic.find_runs(docs.limit(0))).count() == 0


def test_long_texts_take_little_time():
    rng = random.Random(2)
    fib = [b"a"], [b"a", b"b"]
    while len(fib[1]) < 200_000:
        fib = fib[1], fib[1] + fib[0]
    noise = [b"%d" % rng.randrange(300) for _ in range(200_000)]
    assert periodic.runs_of([[b"a"] * 500_000, fib[1], noise])[0] == [periodic.Run(0, 500_000, 1)]


# divergence


def oracle_rows(docs):
    documents = docs.toPandas()  # noqa: F841  (read by name below)
    return sorted(duckdb.connect().sql(queries.ORACLES["op12_divergence"]).fetchall())


@pytest.mark.parametrize("sources", [3, 150])
def test_divergence_equals_sql(spark, sources):
    rng = random.Random(sources)
    word = lambda: "".join(chr(97 + int(26 * rng.random() ** 2)) for _ in range(2)) + rng.choice(["É", "é", "-", "\x85x", "K"])
    rows = [
        (number, rng.choice(["x", "x", "x", None, "y", "rare"]), rng.choice([None, "", *(f"s{int(sources * rng.random() ** 2)}" for _ in range(60))]),
         " ".join(word() for _ in range(rng.randrange(25))) if rng.random() > 0.02 else None)
        for number in range(2_500)
    ]
    rows += [(9_000 + number, "alone", f"s{number}", "few words") for number in range(5)] + [rows[0]] * 40
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string")
    assert sorted(tuple(row) for row in divergence.audit(docs).collect()) == oracle_rows(docs)


def test_divergence_of_odd_tables(spark):
    rows = [("en", "a", "the cat"), ("en", "a", "the cat"), ("en", "b", None), (None, None, "1 2 3"), ("de", "c", "THE \x85É")]
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "lang string, source string, text string, value int, item string")
    got = sorted(tuple(row) for row in divergence.audit(docs, min_docs=1).collect())
    # b has no term: its shares are those of zero counts, 500000000 and one each; a has 7/14 twice
    assert [row for row in got if row[0] == "en" and row[2] == "pair"] == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.audit(docs).where("part = 'term'").count() == 0
    assert divergence.audit(docs).where("value <> 0").count() == 0
    assert divergence.audit(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_tree_walk_equals_the_plain_sum(seed):
    rng = np.random.default_rng(seed)
    rows, units = rng.integers(1, 9, 2).tolist(), int(rng.integers(1, 6))
    side = 1 << (max(*rows, units) - 1).bit_length()
    tables, trees = [], []
    for number in rows:
        zero = rng.integers(1, 50, number)
        held = rng.random((number, units * divergence.LEAF)) < rng.choice([0.0, 0.02, 0.7])
        table = np.where(held, rng.integers(1, 10**9, held.shape), zero[:, None])
        row, column = np.nonzero(held)
        tables.append(table)
        trees.append(divergence.Prices(side, units, zero, row, column, table[row, column]))
    want = np.abs(tables[0][:, None] - tables[1][None]).sum(axis=2)
    assert (divergence.distances(*trees, False) == want).all()
    own = divergence.distances(trees[0], trees[0], True)
    assert (np.triu(own, 1) == np.triu(np.abs(tables[0][:, None] - tables[0][None]).sum(axis=2), 1)).all()


def test_shares_are_exact_for_large_counts(spark):
    rng = random.Random(1)
    rows = [(c, c + rng.randrange(10 ** rng.randrange(1, 15)), rng.randrange(1, 10**6)) for c in (rng.randrange(10 ** rng.randrange(1, 15)) for _ in range(500))]
    table = spark.createDataFrame([*rows, (0, 0, 0), (7, 7, 1)], "c bigint, total bigint, terms bigint")
    for row in table.withColumn("share", divergence.share(F.col("c"), F.col("total"), F.col("terms"))).collect():
        whole = row["total"] + 5 * row["terms"]
        assert row["share"] == 1 + (10**9 * (row["c"] + 5) // whole if row["terms"] else 0)


# quality by neighbours


def slow_features(text, settings_):
    """Counts of 4-grams over a padded text, slot by slot, without arrays of many texts."""
    rows = np.zeros(settings_.features)
    if not text.strip():
        return rows
    shapes = neighbours.shapes()
    for number, codes in enumerate((list(map(ord, f" {text} ".lower())), [int(shapes[ord(c)]) for c in f" {text} "])):
        for i in range(len(codes) - 3):
            key = 0
            for code in codes[i : i + 4]:
                key = (key * 0x1000003 + code) % 2**64
            key = ((key ^ (key >> 29)) * 0x9E3779B97F4A7C15) % 2**64
            rows[number * settings_.slots + (key ^ (key >> 32)) % settings_.slots] += 1
    rows[: 2 * settings_.slots] = np.log1p(rows[: 2 * settings_.slots])
    rows[2 * settings_.slots :] = neighbours.repeats(text, settings_.bins)
    return rows


TEXTS = ["", " \n", "a", "The cat SAT. 12 é\xa0x", "no no no no no", "İstanbul ß 日本", "w " * 600 + "end", "\x00\x1c﻿"]


def test_features_equal_brute_force(monkeypatch):
    settings_ = neighbours.Settings()
    want = np.array([slow_features(text, settings_) for text in TEXTS])
    assert np.allclose(neighbours.raw_features(TEXTS, settings_), want, atol=1e-5)
    monkeypatch.setattr(neighbours, "BLOCK_CHARS", 37)
    assert np.allclose(neighbours.raw_features(TEXTS, settings_), want, atol=1e-5)


def slow_score(model, text):
    """The vote over a plain list of cosines."""
    settings_ = model.settings
    raw = neighbours.raw_features([text], settings_)
    latent = neighbours.weighed(raw, model.idf, settings_)[0] @ model.axes
    latent = latent / max(1e-9, np.linalg.norm(latent))
    cosines = [min(1.0, max(0.0, round(float(latent @ vector), 5))) for vector in model.vectors]
    last = sorted(cosines)[-min(settings_.nearest, len(cosines))]
    votes = [(c**settings_.sharpness * float(w), float(label)) for c, w, label in zip(cosines, model.weights, model.labels) if c >= last]
    total = sum(vote for vote, _ in votes)
    return sum(vote * label for vote, label in votes) / total if total else 0.0


def test_votes_on_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {row["doc_id"]: row for row in queries.op13_quality_votes(spark, folder).collect()}
    assert set(got) == set(docs)
    truth = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for key, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3)
    held = [key for key in truth if key in got and got[key]["held_out"]]
    assert sum(got[key]["predicted"] == truth[key] for key in held) >= 0.95 * len(held)
    assert sum(got[key]["predicted"] for key in held if truth[key]) >= 0.97 * sum(truth[key] for key in held)


def test_votes_equal_brute_force_and_ignore_all_but_the_text(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").selectExpr("doc_id", "quality AS label")
    model = neighbours.fit(docs, labels)
    texts = [row["text"] for row in docs.collect()][:120] + TEXTS
    found = neighbours.scores(model, texts)
    assert found == pytest.approx([slow_score(model, text) for text in texts], abs=2e-3)
    assert neighbours.scores(model, texts[::-1])[::-1] == pytest.approx(found, abs=1e-3)
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "reverse(source) AS source", "0 AS score")
    again = neighbours.fit(other.repartition(3), labels.repartition(2))
    rows = {row["doc_id"]: row["score"] for row in neighbours.score(other, again).collect()}
    assert rows == pytest.approx({row["doc_id"]: row["score"] for row in neighbours.score(docs, model).collect()}, abs=1e-3)


def test_model_is_bounded_and_labels_are_weighed(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('word', id, if(id < 30, ' ### $$$', ' plain text')) AS text")
    labels = docs.selectExpr("doc_id", "cast(doc_id >= 30 as int) AS label")
    model = neighbours.fit(docs, labels, neighbours.Settings(per_label=20))
    assert len(model.vectors) == 40 and sorted(set(model.weights.tolist())) == [1.5, 13.5]
    assert neighbours.scores(model, ["word7 ### $$$", "word200 plain text"]) == [pytest.approx(0, abs=0.2), pytest.approx(1, abs=0.05)]


def test_votes_on_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good text here", 5), (1, "good text here", 5), (2, None, 5), (None, "bad !!!", 5), (4, "", 5), (5, "bad !!! " * 50_000, 5), (6, "bad !!!", 5)],
        f"{DOCS}, label int",
    )
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (6, None), (None, 1), (77, 1), (5, 0), (5, 1)], "doc_id bigint, label int")
    model = neighbours.fit(docs, labels)
    assert sorted(model.labels.tolist()) == [0.0, 0.5, 1.0]
    got = [tuple(row) for row in neighbours.score(docs.withColumn("score", F.lit("x")), model).collect()]
    assert len(got) == 7 and got.count((1, got[0][1], got[0][2])) == 2
    scores = dict((row[0], row[1]) for row in got)
    assert scores[2] == scores[4] == 0.0 and scores[1] > 0.5 > scores[6]
    nothing = neighbours.fit(docs, labels.limit(0))
    assert {row["score"] for row in neighbours.score(docs, nothing).collect()} == {0.0}
    assert neighbours.score(docs.limit(0), model).count() == 0
    empty = neighbours.fit(docs.limit(0), labels)
    assert neighbours.scores(empty, ["x"]) == [0.0]


def test_word_counts_of_divergence_terms():
    text = "Été-the THE\x85x 12a\xa0b\x00c"
    found = Counter(divergence.terms_of(text))
    slow = defaultdict(int)
    for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text):
        slow["".join(c.lower() if "A" <= c <= "Z" else c for c in term).encode()] += 1
    assert found == slow and divergence.terms_of(None) == []
