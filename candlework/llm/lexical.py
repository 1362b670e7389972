"""Ranked lexical search: branch and bound over a trie of restricted term vectors.

A document's vector holds the terms that some item has, most frequent first, so that
vectors of common beginnings share a path of the trie (a frequent-pattern tree over
documents). All vectors are sorted over the cluster; each task holds a run of them, block
by block, as a trie of its own. For what lies below a node, the largest number of
occurrences of each term and the smallest length figure bound the score of any item:
depth first, best bound first, a subtree is left out once its bound falls short of the
item's tenth score. The best of all tasks are ranked at the end.

Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlework.llm.text import ALPHANUMERIC, blocks, words
from candlework.session import stored

TOP = 10
#: Words of items that are searched for in one pass over the documents; more take further passes.
ITEM_WORDS = 1 << 20
#: Terms of the vectors that a task holds as one trie.
BLOCK_TERMS = 1 << 20
#: Terms of the path by which vectors are dealt to tasks.
LEAD = 8
#: Documents below a node that is not split any further, and those too few for a node.
LEAF, FEW = 32, 4
#: The id of a document without one: after all others.
NO_ID = np.iinfo(np.int64).max

_ITEMS = "item bigint, terms array<bigint>, n int"
_VECTORS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
_SORTED = "doc_id bigint, m bigint, terms array<int>, tfs array<int>"
_BEST = "item bigint, doc_id bigint, score bigint"


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _item_terms(batches):
    for batch in batches:
        w = words(batch.column("text"), ALPHANUMERIC)
        terms = _lists(w.hashes().view(np.int64), w.first)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), terms, pa.array(w.counts(), pa.int32())], names=["item", "terms", "n"]
        )


def _vectors(shared):
    """Each document's number of terms, and those of the vocabulary with their occurrences."""

    def run(batches):
        vocabulary = shared.value
        size = len(vocabulary)
        for batch in batches:
            column = batch.column("text")
            for a, b in blocks(column):
                w = words(column.slice(a, b - a), ALPHANUMERIC)
                h = w.hashes()
                term = np.minimum(np.searchsorted(vocabulary, h), size - 1)
                at = np.flatnonzero(vocabulary[term] == h)
                doc = np.searchsorted(w.first, at, side="right") - 1
                keys, tfs = np.unique(doc * size + term[at], return_counts=True)
                offsets = np.searchsorted(keys, np.arange(b - a + 1) * size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(w.counts(), pa.int64()),
                     _lists((keys % size).astype(np.int32), offsets), _lists(tfs.astype(np.int32), offsets)],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return run


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows, and where each row begins."""
    sizes = np.zeros(len(column) + 1, np.int64)
    np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False), out=sizes[1:])
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def _by_frequency(shared, documents: int, length: int):
    """Vectors with terms as their places in the order of frequency, and the length figure m."""

    def run(batches):
        place = shared.value
        for batch in batches:
            terms, offsets = _flat(batch.column("terms"))
            tfs, _ = _flat(batch.column("tfs"))
            doc = np.repeat(np.arange(len(batch)), np.diff(offsets))
            terms = place[terms]
            order = np.lexsort((terms, doc))
            m = 25 + 75 * batch.column("n").to_numpy() * documents // length
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(m, pa.int64()),
                 _lists(terms[order].astype(np.int32), offsets), _lists(tfs[order].astype(np.int32), offsets)],
                names=["doc_id", "m", "terms", "tfs"],
            )

    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


class Trie:
    """Vectors in lexicographic order, as a trie.

    Node k has the units ``first[k] : first[k + 1]``; a unit is a document or another
    node (``node``, -1 for a document). Unit u has the terms ``start[u] : start[u + 1]``
    with the most that each can add to a score per weight (``gain``): exact for a
    document, from the maxima and the minimum below for a node.
    """

    def __init__(self, ids, m, terms, tfs, offsets, size: int):
        parents, levels, units = self._split(terms, offsets)
        docs = len(ids)
        # Units in order of their parents; documents are units 0 .. docs, nodes follow.
        parent = np.array([p for p, _ in units], np.int64)
        own = np.array([u for _, u in units], np.int64)
        order = np.argsort(parent, kind="stable")
        parent, own = parent[order], own[order]
        self.first = np.searchsorted(parent, np.arange(len(levels) + 1))
        low, most, length, ids_low = self._maxima(ids, m, terms, tfs, offsets, parents, levels, parent, own, size)
        term, tf, begin, end = low, most, *length
        counts = (end - begin)[own]
        self.start = np.zeros(len(own) + 1, np.int64)
        np.cumsum(counts, out=self.start[1:])
        at = np.arange(self.start[-1]) + np.repeat(begin[own] - self.start[:-1], counts)
        least, self.id = ids_low[0][own], ids_low[1][own]
        self.term, tf = term[at], tf[at].astype(np.int64)
        self.gain = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(least, counts))
        self.node = np.where(own < docs, -1, own - docs)

    @staticmethod
    def _split(terms, offsets):
        """Parent and level of each node, and all units as (parent, document or docs + node)."""
        docs = len(offsets) - 1
        parents, levels, units = [-1], [0], []
        stack = [(0, 0, docs, 0)]
        while stack:
            node, a, b, depth = stack.pop()
            if b - a > LEAF:
                depth += _common(terms[offsets[a] + depth : offsets[a + 1]], terms[offsets[b - 1] + depth : offsets[b]])
                here = offsets[a:b] + depth
                ended = here >= offsets[a + 1 : b + 1]
                value = np.where(ended, -1, terms[np.where(ended, 0, here)])
                cuts = a + np.flatnonzero(np.diff(value)) + 1
            else:
                cuts = np.zeros(0, np.int64)
            if not len(cuts):
                units.extend((node, d) for d in range(a, b))
                continue
            begins = [a, *cuts.tolist()]
            for x, y in zip(begins, [*begins[1:], b], strict=True):
                if y - x < FEW:
                    units.extend((node, d) for d in range(x, y))
                else:
                    child = len(parents)
                    parents.append(node)
                    levels.append(levels[node] + 1)
                    units.append((node, docs + child))
                    stack.append((child, x, y, depth))
        return np.array(parents, np.int64), np.array(levels, np.int64), units

    @staticmethod
    def _maxima(ids, m, terms, tfs, offsets, parents, levels, parent, own, size):
        """Terms and largest counts of documents and nodes, where each one's are, and least m and id."""
        docs, nodes = len(ids), len(parents)
        least = np.concatenate([m, np.full(nodes, NO_ID)])
        low = np.concatenate([ids, np.full(nodes, NO_ID)])
        above = np.empty(docs + nodes, np.int64)
        above[own] = parent
        begin = np.concatenate([offsets[:-1], np.zeros(nodes, np.int64)])
        end = np.concatenate([offsets[1:], np.zeros(nodes, np.int64)])
        all_terms, all_tfs, placed = [terms], [tfs], len(terms)
        doc_level = levels[above[:docs]]
        entry_doc = np.repeat(np.arange(docs), np.diff(offsets))
        entry_level = doc_level[entry_doc]
        keys = counts = np.zeros(0, np.int64)
        for level in range(int(levels.max()), -1, -1):
            # What the level's nodes have below: documents, and nodes of the next level.
            at = np.flatnonzero(entry_level == level)
            keys = np.concatenate([above[entry_doc[at]] * size + terms[at], parents[keys // size] * size + keys % size])
            counts = np.concatenate([tfs[at], counts])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, counts = keys[new], np.maximum.reduceat(counts, new)
            inside = np.flatnonzero(levels == level)
            begin[docs + inside] = placed + np.searchsorted(keys, inside * size)
            end[docs + inside] = placed + np.searchsorted(keys, (inside + 1) * size)
            all_terms.append(keys % size)
            all_tfs.append(counts)
            placed += len(keys)
            units = np.flatnonzero(np.concatenate([doc_level == level, levels == level + 1]))
            np.minimum.at(least, docs + above[units], least[units])
            np.minimum.at(low, docs + above[units], low[units])
        return np.concatenate(all_terms), np.concatenate(all_tfs), (begin, end), (least, low)

    def search(self, weights: np.ndarray, scores: np.ndarray, ids: np.ndarray, top: int):
        """The ``top`` best of the given ones and the trie's documents: highest score, then smallest id.

        ``weights`` are by term; scores and ids come in that order and go out in it.
        """
        stack = [(NO_ID, -1, 0)]
        while stack:
            bound, low, node = stack.pop()
            if len(scores) == top and (bound < scores[-1] or (bound == scores[-1] and low > ids[-1])):
                continue
            a, b = self.first[node], self.first[node + 1]
            x, y = self.start[a], self.start[b]
            found = np.add.reduceat(weights[self.term[x:y]] * self.gain[x:y], self.start[a:b] - x)
            node, low = self.node[a:b], self.id[a:b]
            good = found > 0
            if len(scores) == top:
                good &= (found > scores[-1]) | ((found == scores[-1]) & (low < ids[-1]))
            here = np.flatnonzero(good & (node < 0))
            if len(here):
                scores, ids = np.concatenate([scores, found[here]]), np.concatenate([ids, low[here]])
                best = np.lexsort((ids, -scores))[:top]
                scores, ids = scores[best], ids[best]
            deeper = np.flatnonzero(good & (node >= 0))
            # The best bound is taken from the stack first.
            for u in deeper[np.argsort(found[deeper], kind="stable")].tolist():
                stack.append((int(found[u]), int(low[u]), int(node[u])))
        return scores, ids


def _search(shared, top: int, block_terms: int):
    """The best documents of each item among the vectors of a task."""

    def run(batches):
        numbers, item_terms, item_weights, size = shared.value
        weights = np.zeros(size, np.int64)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in numbers]
        held, terms_held = [], 0

        def done():
            table = pa.Table.from_batches(held).combine_chunks()
            terms, offsets = _flat(table["terms"].combine_chunks())
            tfs, _ = _flat(table["tfs"].combine_chunks())
            ids = table["doc_id"].fill_null(NO_ID).to_numpy()
            trie = Trie(ids, table["m"].to_numpy(), terms.astype(np.int64), tfs.astype(np.int64), offsets, size)
            for i, (t, w) in enumerate(zip(item_terms, item_weights, strict=True)):
                weights[t] = w
                best[i] = trie.search(weights, *best[i], top)
                weights[t] = 0

        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, 1024)
                at += 1024
                held.append(part)
                terms_held += len(part.column("terms").flatten())
                if terms_held >= block_terms:
                    done()
                    held, terms_held = [], 0
        if held:
            done()
        found = [i for i, (scores, _) in enumerate(best) for _ in scores]
        if found:
            ids = np.concatenate([x for _, x in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[found], pa.int64()), pa.array(ids, pa.int64(), mask=ids == NO_ID),
                 pa.array(np.concatenate([x for x, _ in best]), pa.int64())],
                names=["item", "doc_id", "score"],
            )

    return run


def _items(rows) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Numbers of the items, their distinct terms as places in the vocabulary, how often each, and that."""
    numbers = np.array([r["item"] for r in rows], np.int64)
    each = [np.unique(np.array(r["terms"], np.int64).view(np.uint64), return_counts=True) for r in rows]
    vocabulary = np.unique(np.concatenate([t for t, _ in each]))
    return numbers, [np.searchsorted(vocabulary, t) for t, _ in each], [n for _, n in each], vocabulary


def search(
    docs: DataFrame, benchmark: DataFrame, top: int = TOP, item_words: int = ITEM_WORDS, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each row of ``benchmark``.

    Ids of documents are integers. Every row is a document or an item of its own, also if
    ids or texts repeat; equal scores are ranked by id, documents without an id last. Only
    scores above 0 count, so a null or empty text finds nothing and is not found. Whole
    texts are read and all documents counted; other columns are left out.

    The terms of items are held by the driver and each task, for as many items at a time
    as have some ``item_words`` words together (a longer item is taken as one).
    """
    spark = docs.sparkSession
    items = stored(
        benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
            "item", F.monotonically_increasing_id()
        ),
        "items",
    )
    terms = stored(items.select("item", "text").mapInArrow(_item_terms, _ITEMS).where("n > 0"), "item-terms")
    passes = 1 + (terms.agg(F.sum("n")).first()[0] or 0) // item_words
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    best = spark.createDataFrame([], _BEST)
    for number in range(passes):
        rows = terms.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).collect()
        if rows:
            best = best.unionByName(_best_of(texts, _items(rows), top, block_terms))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return items.select("item", "item_id").join(ranked, "item").select("item_id", "rank", "doc_id", "score")


def _best_of(texts: DataFrame, items, top: int, block_terms: int) -> DataFrame:
    """The best documents of each task for each of ``items``; among them are the best of all."""
    spark = texts.sparkSession
    numbers, item_terms, item_counts, vocabulary = items
    share = spark.sparkContext.broadcast
    vectors = stored(texts.mapInArrow(_vectors(share(vocabulary)), _VECTORS).where("n > 0"), "vectors")
    documents, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return spark.createDataFrame([], _BEST)
    frequency = np.zeros(len(vocabulary), np.int64)
    # A row for each term of the vocabulary at most.
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[r["term"]] = r["count"]
    place = np.empty(len(vocabulary), np.int64)
    place[np.argsort(-frequency, kind="stable")] = np.arange(len(vocabulary))
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in frequency.tolist()])
    weights = [weight[t] * n for t, n in zip(item_terms, item_counts, strict=True)]
    found = vectors.where(F.size("terms") > 0).mapInArrow(_by_frequency(share(place), documents, length), _SORTED)
    # Stored, as the sort reads its rows twice.
    found = stored(found, "by-frequency").withColumn("lead", F.slice("terms", 1, LEAD))
    dealt = found.repartitionByRange("lead", "doc_id").sortWithinPartitions("terms", "doc_id").drop("lead")
    shared = share((numbers, [place[t] for t in item_terms], weights, len(vocabulary)))
    return stored(dealt.mapInArrow(_search(shared, top, block_terms), _BEST), "best")
