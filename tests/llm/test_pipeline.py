import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from flowsight.llm import near_sets
from flowsight.session import written
from tests.conftest import SMALL
from tests.llm.test_texts import slow_languages, slow_quality


def slow_pipeline(docs):
    """The doc ids that the stages keep, each by its plain definition; the table is too small for bands of quality."""
    docs = [doc for doc in docs if not slow_quality(doc["text"])[5]]
    found = slow_languages([(doc["lang"], doc["text"]) for doc in docs], [doc["text"] for doc in docs])
    docs = [doc for doc, (lang, score) in zip(docs, found) if lang != "und" and score >= 0.3]
    groups = defaultdict(list)
    for doc in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", doc["text"])].append(doc)
    docs = [min(group, key=lambda doc: (-len(doc["text"]), doc["doc_id"])) for group in groups.values()]
    return slow_near_sets([(doc["doc_id"], doc["text"]) for doc in docs])


def test_pipeline_equals_brute_force(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    want = slow_pipeline(spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert {row["doc_id"] for row in rows} == want
    tokens = Counter()
    for row in rows:
        tokens[row["doc_id"]] += row["length"]
    assert tokens == {row["doc_id"]: row["doc_tokens"] for row in rows}


def test_stages_keep_all_columns_and_take_odd_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    odd = docs.unionByName(docs.limit(5)).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (7_777, "", "en", "s", 0)], docs.schema)
    ).selectExpr("*", "'x' AS component_id", "1 AS kept", "'y' AS score")
    for table in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, table, SMALL)
            assert kept.columns == odd.columns
            assert kept.count() <= odd.count()
        assert (corpus_pipeline.STAGES[-1][1](spark, table, SMALL).count() > 0) == (table is odd)


def slow_near_sets(rows, least=0.8):
    """Doc ids that are the least of their component, over all pairs of sets."""
    sets = {}
    for key, text in rows:
        words = text.lower().split()
        sets[key] = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {key: key for key in sets}

    def top(key):
        while root[key] != key:
            key = root[key]
        return key

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {key for key in sets if top(key) == key}


def test_near_stage_takes_five_words_and_similarity_of_eight_tenths(spark):
    rng = random.Random(3)
    draw = lambda n: [f"w{rng.randrange(10_000)}" for _ in range(n)]
    rows = []
    for _ in range(12):
        base = draw(120)
        rows.append(base)
        for changes in (1, 2, 2, 3, 4, 6):
            copy = list(base)
            for place in rng.sample(range(120), changes):
                copy[place] = "new" + str(rng.randrange(10_000))
            rows.append(copy)
    passage = draw(20)
    rows += [draw(40) + passage + draw(40) for _ in range(20)] + [draw(3), [], []]
    rows = [(place, " ".join(words)) for place, words in enumerate(rows)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {row["doc_id"] for row in corpus_pipeline.without_near_copies(spark, docs, SMALL).collect()}
    assert kept == slow_near_sets(rows)
    assert near_sets.first_of_each(docs.limit(0)).count() == 0


def test_near_copies_of_a_larger_table_are_found(spark):
    """All pairs of 1,000 documents, of which the stage must join at least nine in ten of those that are alike."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {}
    for row in docs.collect():
        words = row["text"].encode().lower().split()
        sets.setdefault(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))), row["doc_id"])
    found = list(sets)
    alike = [
        (sets[a], sets[b]) for place, a in enumerate(found) for b in found[:place]
        if 0.8 * max(len(a), len(b)) <= min(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b)
    ]
    rows = written(near_sets.signatures(docs, "text", 5), "signatures")
    names = near_sets.added_names(docs)
    rows = rows.select("doc_id", "text", *(F.col(names[name]).alias(name) for name in ("node", "keys", "minima")))
    roots = {row["node"]: row["root"] for row in near_sets.set_components(rows, 5, 0.8).collect()}
    node = {row["doc_id"]: row["node"] for row in rows.collect()}
    joined = sum(roots.get(node[a], node[a]) == roots.get(node[b], node[b]) for a, b in alike)
    assert len(alike) >= 3 and joined >= 0.9 * len(alike)


def test_near_stage_of_a_ball_that_stays_apart(spark):
    """Texts of a ball that share bands, but of which hardly two are alike enough: hubs do not join them, pairs must."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10_000)}" for _ in range(200)]
    rows = []
    for _ in range(60):
        copy = list(base)
        for place in rng.sample(range(200), rng.choice([1, 2, 3, 5, 6, 7])):
            copy[place] = f"n{rng.randrange(100_000)}"
        rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {row["doc_id"] for row in near_sets.first_of_each(docs).collect()}
    assert kept == slow_near_sets(rows) and 2 < len(kept) < 60


def ball_and_strangers(rng):
    """Texts of a ball that mostly stay apart, near copies of one of them, and other texts."""
    base = [f"w{rng.randrange(10_000)}" for _ in range(150)]
    rows = []
    for _ in range(120):
        copy = list(base)
        for place in rng.sample(range(150), rng.choice([3, 4, 5])):
            copy[place] = f"n{rng.randrange(100_000)}"
        rows.append(copy)
    rows += [[*rows[0], *(f"e{number}" for number in range(extra))] for extra in range(1, 30)]
    rows += [[f"w{rng.randrange(10_000)}" for _ in range(30)] for _ in range(20)]
    return [(place, " ".join(words)) for place, words in enumerate(rows)]


def test_near_stage_compares_a_ball_without_a_row_for_each_pair(spark, monkeypatch):
    rows = ball_and_strangers(random.Random(11))
    asked = []
    joined = near_sets.near_enough

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return joined(pairs, *rest)

    monkeypatch.setattr(near_sets, "near_enough", counted)
    kept = {row["doc_id"] for row in near_sets.first_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert kept == slow_near_sets(rows) and 20 < len(kept) < 149
    # each node with one of its SimHash group and one of each band, at most
    assert sum(asked) < 10 * len(rows)


def test_bands_are_compared_whole_in_blocks_of_any_size(spark):
    rows = ball_and_strangers(random.Random(12))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = near_sets.signatures(docs.coalesce(1), "text", 5)
    names = near_sets.added_names(docs)
    signed = written(signed.select("doc_id", "text", *(F.col(names[c]).alias(c) for c in ("node", "keys", "minima"))), "signed")
    found = []
    for block, hubs in ((4_000, 3), (7, 1), (40, 0)):
        roots = {row["node"]: row["root"] for row in near_sets.set_components(signed, 5, 0.8, hubs, block).collect()}
        groups = defaultdict(set)
        for row in signed.collect():
            groups[roots.get(row["node"], row["node"])].add(row["doc_id"])
        found.append({frozenset(group) for group in groups.values()})
    assert found[0] == found[1] == found[2]
    assert {min(group) for group in found[0]} == slow_near_sets(rows)


def test_texts_that_are_not_asked_for_are_not_shuffled(spark, monkeypatch):
    texts = written(spark.createDataFrame([(number, f"text number {number}") for number in range(500)], "node bigint, text string"), "texts")
    asked = spark.range(0, 500, 7).withColumnRenamed("id", "node")
    plans, batches = [], near_sets.map_batches

    def planned(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return batches(df, *rest)

    monkeypatch.setattr(near_sets, "map_batches", planned)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64")
    try:
        first = {row["node"]: row["hashes"] for row in near_sets.shingle_sets(texts, asked, 5).collect()}
        monkeypatch.setattr(near_sets, "ASKED", 70)
        second = {row["node"]: row["hashes"] for row in near_sets.shingle_sets(texts, asked, 5).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert first == second and len(first) == 72
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]


def test_near_stage_of_rows_without_ids_and_of_one_id(spark):
    long = " ".join(f"w{number}" for number in range(100))
    rows = [(None, long, "a"), (None, long + " x", "b"), (5, long + " y", "c"), (5, "another text of one id", "d"), (5, long, "e"),
            (None, None, "f"), (7, " ", "g"), (7, "", "h"), (8, "single words here", "i"), (8, "single words here", "i")]
    docs = spark.createDataFrame([(*row, 1, 2) for row in rows], "doc_id bigint, text string, tag string, _node int, minima int")
    kept = near_sets.first_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(row["tag"] for row in kept.collect())
    # one row of each group, by the least id; null ids do not stay beside it, and the other text of id 5 does
    assert len(got) == 4 and {"d", "i"} <= set(got) and ("c" in got) != ("e" in got) and ("g" in got) != ("h" in got)


def test_near_stage_takes_simhash_groups_and_checks_them(spark):
    """Fingerprints at most 3 bits apart are candidates by themselves, without bands; whole sets decide."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10_000)}" for _ in range(2_000)]
    rows = [(0, " ".join(base)), (1, " ".join([*base, "more"])), (2, " ".join(rng.sample(base, 2_000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    signed = near_sets.signatures(docs, "text", 5)
    names = near_sets.added_names(docs)
    rows = written(signed.select("doc_id", "text", *(F.col(names[c]).alias(c) for c in ("node", "print", "minima"))), "signed")
    prints = {row["doc_id"]: row["print"] % (1 << 64) for row in rows.collect()}
    assert (prints[0] ^ prints[1]).bit_count() <= 3 < (prints[0] ^ prints[2]).bit_count()
    alone = rows.withColumn("keys", F.array(F.col("doc_id")))
    assert near_sets.set_components(alone, 5, 0.8).count() == 1


def test_stages_are_in_order_and_named():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "language ID", "exact dedup", "SimHash near-dedup", "packing",
    ]


def test_the_entry_works_without_these_operators():
    code = "import sys; sys.modules['flowsight.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=Path(__file__).parents[2])
    assert found.returncode == 0, found.stderr
    assert found.stdout.split()[1] == "False" and int(found.stdout.split()[0]) > 70


def test_simhash_groups_broadcast_no_exploded_keys(spark, plan_of, monkeypatch):
    plans, roots_of = [], near_sets.component_roots
    monkeypatch.setattr(near_sets, "component_roots", lambda links: plans.append(plan_of(links)) or roots_of(links))
    prints = [0, 1, 3, 1 << 40, (1 << 62) - 1]
    nodes = spark.createDataFrame([(fp, place) for place, fp in enumerate(prints)], "print bigint, node bigint")
    pairs = {tuple(row) for row in near_sets.simhash_pairs(nodes).collect()}
    assert {v for _, v in pairs} == {1, 2, 3} and {u for u, _ in pairs} == {0}
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
