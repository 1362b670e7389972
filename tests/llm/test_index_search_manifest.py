"""Lexical search, the Merkle manifest and the digest index against brute force, and over awkward rows."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlework.llm import catalog, exact_dedup, lexical, merkle
from candlework.session import scratch_path, stored
from tests.llm import brute

FIELDS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def of(docs, *columns):
    return [tuple(r) for r in docs.select(*columns).collect()]


def tampered(docs):
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return F.when(chosen, merkle.leaf_digest(merkle.lower_cased(F.col("text"))))


# ---- lexical search


def test_search(spark, table, awkward, empty):
    odd = [(1, "one ONE w1 w2 w2"), (1, "one ONE w1 w2 w2"), (None, "no w3 id"), (2, None), (3, ""), (4, "nowhere"),
           (5, "é 梦 x9"), (6, LONG_ITEM)]
    odd = spark.createDataFrame(odd, "item_id bigint, text string")
    for docs, items in ((table("documents"), table("benchmark")), (awkward, odd)):
        expected = brute.ranked(of(docs, "doc_id", "text"), of(items, "item_id", "text"))
        assert rows(lexical.search(docs, items)) == collections.Counter(expected)
    assert lexical.search(empty, odd).count() == 0
    assert lexical.search(awkward, odd.limit(0)).count() == 0
    assert lexical.search(awkward.where("text = ''"), odd).count() == 0


LONG_ITEM = " ".join(f"w{i % 31} w{i}" for i in range(3_000))


def test_search_in_several_passes_and_small_blocks(spark, table):
    """Items beyond one pass, many tries in a task and a shorter list change nothing."""
    docs, items = table("documents"), table("benchmark")
    expected = brute.ranked(of(docs, "doc_id", "text"), of(items, "item_id", "text"), 3)
    got = lexical.search(docs.repartition(7), items, top=3, item_words=150, block_terms=2_000)
    assert rows(got) == collections.Counter(expected)


def test_search_among_copies(spark):
    """Equal scores are ranked by id, however many there are and wherever they lie."""
    docs = [(i, "alpha beta beta gamma") for i in range(3_000)] + [(None, "alpha beta beta gamma"), (3_000, "alpha")]
    docs += [(10_000 + i, f"delta w{i}") for i in range(500)]
    random.Random(1).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(9)
    items = [(0, "beta gamma"), (1, "delta"), (2, "alpha delta"), (3, "w7 w8 w9")]
    got = lexical.search(df, spark.createDataFrame(items, "item_id bigint, text string"), block_terms=500)
    assert rows(got) == collections.Counter(brute.ranked(docs, items))


@pytest.mark.parametrize("seed", range(4))
def test_trie_finds_the_best(seed):
    """Against scores of all documents, and looking at a part of them only."""
    rng = np.random.default_rng(seed)
    size, n = 40, 900
    vectors = set()
    while len(vectors) < n // 2:
        vectors.add(tuple(np.flatnonzero(rng.random(size) < np.linspace(0.9, 0.02, size)).tolist()) or (0,))
    vectors = sorted([*vectors, *[sorted(vectors)[i] for i in rng.integers(0, n // 2, n // 2)]])
    offsets = np.cumsum([0, *map(len, vectors)])
    terms = np.concatenate([np.array(v) for v in vectors])
    tfs = rng.integers(1, 9, len(terms))
    ids, m = rng.permutation(n), rng.integers(25, 400, n)
    trie = lexical.Trie(ids, m, terms, tfs, offsets, size)
    gains = 1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, np.diff(offsets)))
    assert sorted(trie.id[trie.node < 0].tolist()) == list(range(n))
    for _ in range(60):
        weights = np.zeros(size, np.int64)
        weights[rng.integers(0, size, 5)] = rng.integers(0, 5_000, 5)
        every = np.add.reduceat(weights[terms] * gains, offsets[:-1])
        best = [i for i in np.lexsort((ids, -every)) if every[i] > 0][:10]
        scores, found = trie.search(weights, np.zeros(0, np.int64), np.zeros(0, np.int64), 10)
        assert found.tolist() == ids[best].tolist() and scores.tolist() == every[best].tolist()
        again = trie.search(weights, np.array([10**12] * 10), np.arange(10), 10)
        assert again[1].tolist() == list(range(10))


def test_bounds_hold_for_all_that_lies_below():
    rng = np.random.default_rng(9)
    vectors = sorted(tuple(np.flatnonzero(rng.random(30) < 0.5).tolist()) or (1,) for _ in range(600))
    offsets = np.cumsum([0, *map(len, vectors)])
    terms = np.concatenate([np.array(v) for v in vectors])
    tfs, m = rng.integers(1, 50, len(terms)), rng.integers(25, 900, 600)
    trie = lexical.Trie(np.arange(600), m, terms, tfs, offsets, 30)

    def gains(u):
        return dict(zip(trie.term[trie.start[u] : trie.start[u + 1]], trie.gain[trie.start[u] : trie.start[u + 1]], strict=True))

    nodes = np.flatnonzero(trie.node >= 0)
    assert len(nodes) > 10
    for u in nodes:
        bound = gains(u)
        for below in range(trie.first[trie.node[u]], trie.first[trie.node[u] + 1]):
            assert all(bound[t] >= g for t, g in gains(below).items()) and trie.id[u] <= trie.id[below]


# ---- Merkle manifest


def test_manifest(spark, table, awkward, empty):
    for docs in (table("documents"), awkward, table("documents").limit(1)):
        expected = brute.merkle([r.asDict() for r in docs.collect()])
        assert rows(merkle.manifest(docs, tampered(docs))) == collections.Counter(expected)
    assert merkle.manifest(empty, tampered(empty)).count() == 0


def test_manifest_of_sources_of_all_sizes(spark):
    """One leaf, full and broken runs, runs of one node, a null source, more sources than a run holds."""
    sizes = [1, 2, 15, 16, 17, 31, 33, 256, 257, 273, *[1] * 20]
    docs = [(i * 100 + s, f"é{s}" if s else None, None, n, f"Text {i}") for s, n in enumerate(sizes) for i in range(n)]
    docs += docs[:3]
    random.Random(2).shuffle(docs)
    df = spark.createDataFrame(docs, FIELDS).repartition(5)
    expected = brute.merkle([r.asDict() for r in df.collect()])
    got = merkle.manifest(df, tampered(df))
    assert rows(got) == collections.Counter(expected)
    assert got.select("root").distinct().count() == 1


def test_proofs_show_any_change(spark, table):
    docs = table("documents")
    assert merkle.manifest(docs).where("verified").count() == docs.count()
    for column, value in (("source", "x"), ("lang", "x"), ("n_chars", -1), ("doc_id", -1)):
        changed = docs.withColumn(column, F.lit(value))
        digests = changed.select("text", merkle.leaf_digest().alias("changed"))
        both = docs.join(digests.dropDuplicates(["text"]), "text", "left")
        assert merkle.manifest(both, F.col("changed")).where("verified").count() == 0


# ---- digest index


def in_deliveries(spark, docs, n, seed):
    """All rows of the docs, the deliveries' digests and a new index."""
    order = list(docs)
    random.Random(seed).shuffle(order)
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"), buckets=4)
    parts = [order[i::n] for i in range(n)]
    digests = [
        stored(exact_dedup.digested(spark.createDataFrame(p, "doc_id bigint, text string")).withColumn("delivery", F.lit(f"d{i}")), "d")
        for i, p in enumerate(parts)
    ]
    return parts, digests, index


def union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def test_digest_index(spark, table):
    docs = of(table("documents"), "doc_id", "text")
    docs += [(i + 5_000, re.sub(" ", "  ", t)) for i, (_, t) in enumerate(docs[:40])] + [(9_000 + i, "Hot\n") for i in range(900)]
    docs += [(8_000, None), (8_001, ""), (8_002, " \t\r\n\x0b\x0c"), (8_003, " ")]
    parts, digests, index = in_deliveries(spark, docs, 3, 4)
    seen = set()
    for i, d in enumerate(digests):
        fresh = index.add(d, f"d{i}")
        texts = {re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in parts[i]}
        assert {bytes(r["digest"]).hex() for r in fresh.collect()} == {brute.sha(t) for t in texts - seen}
        seen |= texts
        # At any time, the rows so far are judged as if they had come at once.
        expected = brute.copies([x for p in parts[: i + 1] for x in p])
        assert rows(exact_dedup.judged(union(digests[: i + 1]), index)) == collections.Counter(expected)
    # Adding a delivery again replaces it.
    index.add(digests[1], "d1")
    assert rows(exact_dedup.judged(union(digests), index)) == collections.Counter(expected)
    # Another session finds the index on disk.
    spark.sql(f"DROP TABLE {index.table}")
    later = exact_dedup.DigestIndex(spark, index.path, buckets=4)
    assert rows(exact_dedup.judged(union(digests), later)) == collections.Counter(expected)


def test_awkward_rows_of_the_digest_index(spark, awkward, empty):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"), buckets=2)
    digests = stored(exact_dedup.digested(awkward).withColumn("delivery", F.lit("it's 2")), "d")
    index.add(digests, "it's 2")
    got = exact_dedup.judged(digests, index)
    # Which of two rows alike in id and text stays does not show in the result.
    assert rows(got) == collections.Counter(brute.copies(of(awkward, "doc_id", "text")))
    nothing = stored(exact_dedup.digested(empty).withColumn("delivery", F.lit("none")), "d")
    assert index.add(nothing, "none").count() == 0
    assert rows(exact_dedup.judged(digests, index)) == rows(got)
    assert exact_dedup.judged(nothing, index).count() == 0


def test_only_new_rows_pass(spark, awkward):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"), buckets=2)
    docs = stored(awkward, "docs")
    first = exact_dedup.deduplicated(docs, index, "a")
    assert first.columns == awkward.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in first.collect()) == sorted(
        [(2, ""), (4, "one"), (7, "ONE"), (5, docs.where("doc_id = 5").first()["text"]), (8, "x" * 70_000),
         (9, "é ñ ß 梦 \U0001f600 <|im_end|> a\\b"), (0, "no id here")][1:] + [(3, " \n\t")]
    )
    assert exact_dedup.deduplicated(docs, index, "b").count() == 0


def test_the_index_is_not_shuffled(spark, table):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"))
    digests = stored(exact_dedup.digested(table("documents")).withColumn("delivery", F.lit("a")), "d")
    index.add(digests, "a")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in plan(index.groups())
    known = index.entries().select("digest").hint("merge")
    joined = plan(digests.select("digest").repartition(index.buckets, "digest").join(known, "digest", "left_anti"))
    assert "SortMergeJoin" in joined and joined.count("Exchange") == 1


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_exact_dedup"])
def test_no_python_where_columns_do(spark, small, name):
    plan = catalog.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
