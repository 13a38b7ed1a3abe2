from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from refinery.llm import digest_index, tensor_dedup
from refinery.llm.components import components
from refinery.llm.queries import ORACLES, QUERIES
from refinery.session import scratch_path
from tests.compare import difference, duckdb_over
from tests.conftest import TABLES
from tests.llm.cases import empty, messy, texts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_sets(rows, n):
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        size = min(n, len(words))
        sets[doc_id] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    return sets


def plain_groups(rows, n, percent):
    """Every pair compared."""
    sets = plain_sets(rows, n)
    group = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            old, new = sorted((group[a], group[b]), reverse=True)
            group = {k: new if v == old else v for k, v in group.items()}
    return {i: (len(sets[i]), group[i], group[i] == i) for i in sets}


def found_groups(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_near_query(spark):
    assert found_groups(QUERIES["op1_tensor_dedup"](spark, TABLES)) == plain_groups(texts_of(TABLES), 3, 85)


def variants(source, base, count, edits, first):
    rows = []
    for i in range(count):
        words = list(base)
        for _ in range(source.randint(0, edits)):
            words[source.randrange(len(words))] = f"w{source.randrange(10**6)}"
        rows.append((first + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [16, 384])
def test_groups_of_near_copies(spark, monkeypatch, block):
    """Many variants of one text, of similarities on either side of the limit."""
    monkeypatch.setattr(tensor_dedup, "BLOCK", block)
    source = random.Random(5)
    rows = []
    for group, (count, edits) in enumerate([(90, 8), (40, 3), (25, 20)]):
        base = [f"b{source.randrange(10**6)}" for _ in range(120)]
        rows += variants(source, base, count, edits, 1000 * group)
    rows += [(5000 + i, f"short {i % 4}") for i in range(8)]
    found = tensor_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    expected = plain_groups(rows, 3, 85)
    assert found_groups(found) == expected
    assert 20 < len({x[1] for x in expected.values()}) < len(rows)


def test_a_large_cluster_is_joined_in_proportion(spark, monkeypatch):
    """Twice as many near copies of one text make twice as many rows to compare, not four
    times, and the groups are those of the plain version."""
    monkeypatch.setattr(tensor_dedup, "BLOCK", 32)
    monkeypatch.setattr(tensor_dedup, "PIVOTS", 8)
    joined = []
    for count in (300, 600):
        source = random.Random(count)
        base = [f"b{source.randrange(10**6)}" for _ in range(150)]
        rows = variants(source, base, count, 4, 0) + variants(source, base[:75] + base[100:], 20, 2, 5000)
        work, plain = [], tensor_dedup.materialize

        def counted(df, label):
            out = plain(df, label)
            if label == "comparisons":
                work.append(out.count())
            return out

        with monkeypatch.context() as patch:
            patch.setattr(tensor_dedup, "materialize", counted)
            found = tensor_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
            assert found_groups(found) == plain_groups(rows, 3, 85)
        joined.append(sum(work))
    assert joined[1] < 3 * joined[0] and joined[1] < 12 * 620


def test_a_cluster_of_texts_that_are_not_linked(spark, monkeypatch):
    """Candidates that hang together but fall apart into many groups are compared whole."""
    monkeypatch.setattr(tensor_dedup, "BLOCK", 8)
    source = random.Random(11)
    base = [f"b{source.randrange(10**6)}" for _ in range(60)]
    rows = []
    for step in range(120):  # each differs a little from the one before, and much from the first
        for place in source.sample(range(60), 1 if step % 10 else 3):
            base[place] = f"n{step}"
        rows.append((step, " ".join(base)))
    source.shuffle(rows)
    found = tensor_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    expected = plain_groups(rows, 3, 85)
    assert found_groups(found) == expected and len({x[1] for x in expected.values()}) > 3


def test_awkward_texts_and_near_groups(spark):
    docs = messy(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    found = tensor_dedup.near_groups(docs, 5, 80)
    assert found.count() == docs.count()
    assert found_groups(found.filter("doc_id IS NOT NULL")) == plain_groups(rows, 5, 80)
    assert found.filter("doc_id IS NULL AND component_id IS NULL AND kept").count() == 2
    assert tensor_dedup.near_groups(empty(spark)).count() == 0
    stay = tensor_dedup.drop_near(docs)
    assert stay.columns == docs.columns
    assert {r["doc_id"] for r in stay.collect()} == {r["doc_id"] for r in found.filter("kept").collect()}


def test_rows_of_one_id_are_one_document(spark):
    rows = [(1, "a b c d e f g"), (2, "p q r s t u v"), (1, "p q r s t u v"), (3, "other words here now")]
    found = tensor_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (2, 1), (3, 3)}


def test_sub_keys_hardly_ever_miss():
    """Sets at similarity 0.85 meet in a table."""
    source = np.random.RandomState(1)
    missed = 0
    for _ in range(300):
        shared, a, b = (source.randint(0, 2**62, n).astype(np.uint64) for n in (850, 75, 75))
        one, other = tensor_dedup.subkeys(np.concatenate([shared, a])), tensor_dedup.subkeys(np.concatenate([shared, b]))
        same = one == other
        missed += not (same[: tensor_dedup.SUBKEYS].any() and same[tensor_dedup.SUBKEYS :].any())
    assert missed == 0


def test_components(spark):
    source = random.Random(2)
    edges = [(source.randrange(400), source.randrange(400)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    group = {x: x for e in edges for x in e}
    for a, b in edges:
        old, new = sorted((group[a], group[b]), reverse=True)
        group = {k: new if v == old else v for k, v in group.items()}
    assert found == {k: v for k, v in group.items() if k in found}
    assert {k for k in group if k not in found} == {a for a, b in edges if sum(a in e for e in edges) == sum(e == (a, a) for e in edges)}


def test_exact_query(spark):
    assert difference(QUERIES["op10_digest_index"](spark, TABLES), duckdb_over(TABLES), ORACLES["op10_digest_index"]) == ""


def test_index_outlives_its_declaration(spark):
    folder = scratch_path(spark, "index")
    docs = spark.createDataFrame([(5, "a  b"), (7, "a b"), (8, "c")], "doc_id long, text string")
    more = spark.createDataFrame([(1, "a\tb"), (2, "d"), (3, "d"), (8, None)], "doc_id long, text string")
    first = digest_index.decide(digest_index.DigestIndex(spark, folder), docs)
    assert {(r[0], r[1], r[2], r[3]) for r in first.collect()} == {(5, 5, 2, True), (7, 5, 2, False), (8, 8, 1, True)}
    again = digest_index.DigestIndex(spark, folder)
    second = digest_index.decide(again, more)
    assert {(r[0], r[1], r[2], r[3]) for r in second.collect()} == {(1, 5, 1, False), (2, 2, 2, True), (3, 2, 2, False), (8, 8, 1, True)}
    assert again.rows().count() == 4
    third = digest_index.decide(again, docs.limit(0))
    assert third.count() == 0 and again.rows().count() == 4


def groups_of(docs):
    return digest_index.batch_groups(docs.select("doc_id", digest_index.text_digest("text").alias("digest")))


def test_index_is_read_in_order_and_without_a_shuffle(spark):
    """Also after several loads: each bucket is one sorted file."""
    index = digest_index.DigestIndex(spark, scratch_path(spark, "index"), buckets=4)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 200).alias("text"))
    for load in range(3):
        index.add(groups_of(docs.filter(F.col("doc_id") % 3 == load)))
    with index.declared() as name, index.in_order():
        joined = index.unknown(groups_of(messy(spark)), name)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() > 0
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [digest") == 1 and "Bucketed: true" in plan
    assert index.files(index.generation()) == 4 and index.rows().count() == 200
    assert index.rows().select("digest").distinct().count() == 200


def test_index_leaves_no_tables_and_remembers_its_buckets(spark):
    before = {t.name for t in spark.catalog.listTables()}
    folder = scratch_path(spark, "index")
    digest_index.DigestIndex(spark, folder, buckets=3).add(groups_of(messy(spark)))
    again = digest_index.DigestIndex(spark, folder)
    again.add(groups_of(spark.createDataFrame([(1, "new")], "doc_id long, text string")))
    assert again.buckets == 3 and {t.name for t in spark.catalog.listTables()} == before


def test_files_pile_up_to_the_number_allowed(spark):
    index = digest_index.DigestIndex(spark, scratch_path(spark, "index"), buckets=1, most_files=3)
    for load in range(5):
        index.add(groups_of(spark.createDataFrame([(load, f"text {load}"), (9, "same")], "doc_id long, text string")))
        assert index.rows().count() == load + 2
    assert index.files(index.generation()) <= 3


@pytest.mark.parametrize("loads", [2, 5])
def test_loads_by_ascending_id_give_the_same_as_one(spark, loads):
    docs = messy(spark).select("doc_id", "text").unionByName(spark.range(100, 400).selectExpr("id AS doc_id", "concat('t', id % 130) AS text"))
    index = digest_index.fresh_index(spark)
    met = []
    plain = index.add
    index.add = lambda groups: (met.append(index.rows().count() if met else 0), plain(groups))
    several = digest_index.decide(index, docs, loads=loads)
    one = digest_index.decide(digest_index.fresh_index(spark), docs)
    assert sorted(map(repr, several.collect())) == sorted(map(repr, one.collect()))
    assert len(met) == loads and met[-1] > 0  # the later loads meet a filled index


def test_of_copies_of_one_document_the_same_one_stays(spark):
    rows = [(1, "a  b", "z"), (1, "a b", "y"), (1, "a b", "y"), (1, "c", "x"), (2, "c", "w"), (None, "d", "v"), (None, "d", "u"), (3, "a b", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("more", F.create_map("source", "text"))
    found = {
        tuple(sorted((r["doc_id"] or 0, r["text"], r["source"]) for r in digest_index.drop_copies(own).collect()))
        for own in (docs, docs.orderBy(F.desc("source")).repartition(4), docs.orderBy("source").coalesce(1))
    }
    assert len(found) == 1
    (stay,) = found
    assert [(i, t.replace("  ", " ")) for i, t, _ in stay] == [(0, "d"), (1, "a b"), (1, "c")]


def test_awkward_texts_and_copies(spark):
    docs = messy(spark)
    found = digest_index.exact_report(docs)
    assert found.count() == docs.count()
    rows = {(r["doc_id"], r["text_sha256"]): r for r in found.collect()}
    by_id = {k[0]: r for k, r in rows.items() if k[0] is not None}
    assert by_id[2]["keep_id"] == 1 and by_id[11]["keep_id"] == 1 and by_id[1]["group_size"] == 3
    assert by_id[3]["keep_id"] == 3 and by_id[4]["keep_id"] == 3 and by_id[3]["group_size"] == 3
    assert by_id[10]["group_size"] == 2 and by_id[10]["kept"]
    stay = digest_index.drop_copies(docs)
    assert stay.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in stay.collect()) == [0, 1, 3, 5, 6, 7, 8, 9, 10]
    assert digest_index.exact_report(empty(spark)).count() == 0


def test_a_very_frequent_text(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t "), "id")).alias("text")
    )
    found = digest_index.exact_report(docs)
    assert found.filter("NOT kept").count() == 1999 and found.filter("group_size = 2000 AND keep_id = 0").count() == 2000
