"""Near-duplicate documents: a grouped prefix join on sets of word shingles.

Two sets of sizes x and y have a Jaccard similarity of 0.8 exactly if they share at
least 4 (x + y) / 9 shingles. With all sets in one order, such sets share one already
within the first fifth of each, at places that leave enough for the rest to be shared.

Any order is right; it decides only how many candidates there are. Shingles that many
documents have come last, by how many; the others by hash. Documents of equal size and
prefix are one group; groups are paired on prefix shingles, and a pair is expanded to
its documents.

Pairs are not listed without need, as only components are asked for. In each bucket of
a shingle all documents are compared with its most central one first. What remains
are documents of one bucket that are not linked yet; those are compared in full.

In large tables very many pairs share a shingle by chance; they grow as the square of
the documents. So no text is moved for a pair before its prefixes, each shingle cut to
16 bits, are known to share as many as those of two sets so alike do at least.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlework.llm.filters import only_ids, without_ids
from candlework.llm.graph import components
from candlework.llm.text import NOT_SPACE, U64, blocks, shingle_sets, words
from candlework.session import shuffles_freed, stored

SHINGLE = 5
#: Shingles that are counted and broadcast at most: 2 MB. It bounds the detail of the order, not the results.
COMMON = 1 << 17
#: Shingles that are counted at a time in a task.
COUNTED = 1 << 22
_SIEVE = 22
#: Columns of a pair of groups: ids and sizes.
_PAIR = ["a", "n_a", "b", "n_b"]


def _common_counts(batches):
    """Shingles that occur in two or more documents of one part of a task, with their number there.

    A shingle loses a count of one for each part at most.
    """

    def counted(sets):
        found, n = np.unique(np.concatenate(sets), return_counts=True)
        at = np.flatnonzero(n > 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(found[at].view(np.int64)), pa.array(n[at], pa.int64())], names=["token", "n"]
        )

    sets, size = [], 0
    for batch in batches:
        column = batch.column("text")
        for a, b in blocks(column):
            for s in shingle_sets(words(column.slice(a, b - a), NOT_SPACE), SHINGLE):
                sets.append(s)
                size += len(s)
            if size >= COUNTED:
                yield counted(sets)
                sets, size = [], 0
    if sets:
        yield counted(sets)


def common_shingles(docs: DataFrame, limit: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles of all documents (sorted) and their counts; at most ``limit``."""
    counts = stored(
        docs.select("text").mapInArrow(_common_counts, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")),
        "common",
    )
    # Eighths of a doubling: few rows, whatever the counts.
    step = F.floor(F.log2("n") * 8)
    room, least = limit, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    got = counts.where(step >= least).toArrow()
    tokens, n = got["token"].to_numpy().view(U64), got["n"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], n[order]


def _digest(values: np.ndarray) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(values.tobytes(), digest_size=16).digest(), np.int64)


def _sketch(shared, key):
    def ordered(sets):
        """The sets in the common order, and how many of each come before the common shingles."""
        tokens, counts, sieve = shared.value
        sizes = [len(s) for s in sets]
        every = np.concatenate(sets)
        rank = np.zeros(len(every), np.int64)
        if len(tokens):
            at = np.flatnonzero(sieve[every & U64((1 << _SIEVE) - 1)])
            place = np.minimum(np.searchsorted(tokens, every[at]), len(tokens) - 1)
            same = tokens[place] == every[at]
            rank[at[same]] = counts[place[same]]
        out, a = [], 0
        for s, n in zip(sets, sizes, strict=True):
            r = rank[a : a + n]
            cold = int(n - np.count_nonzero(r))
            out.append((s if cold == n else s[np.argsort(r, kind="stable")], cold))
            a += n
        return out

    def run(batches):
        for batch in batches:
            column = batch.column("text")
            for a, b in blocks(column):
                sets = shingle_sets(words(column.slice(a, b - a), NOT_SPACE), SHINGLE)
                rows = []
                for s, (o, cold) in zip(sets, ordered(sets), strict=True):
                    n = len(s)
                    prefix = o[: n - (4 * n + 4) // 5 + 1] if n else o
                    rows.append((n, cold, *_digest(s), *_digest(prefix), prefix.view(np.int64)))
                n, cold, d1, d2, p1, p2, prefix = zip(*rows, strict=True)
                offsets = np.append(0, np.cumsum([len(p) for p in prefix])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(a, b - a)]
                    + [pa.array(np.array(c, np.int64)) for c in (n, cold, d1, d2, p1, p2)]
                    + [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefix)))],
                    names=["id", "n", "cold", "d1", "d2", "p1", "p2", "prefix"],
                )

    return run


def _sets_of(column: pa.Array) -> list[np.ndarray]:
    """The set of each text; the set of a text that comes again is made once."""
    once = column.dictionary_encode()
    sets = []
    for a, b in blocks(once.dictionary):
        sets += shingle_sets(words(once.dictionary.slice(a, b - a), NOT_SPACE), SHINGLE)
    return [sets[i] for i in once.indices.to_pylist()]


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two arrays share; if an array has a value twice, at least so many."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _linked(batches):
    for batch in batches:
        x, y = batch.column("text_a"), batch.column("text_b")
        keep = []
        for start, stop in blocks(x):
            for a, b in zip(*(_sets_of(c.slice(start, stop - start)) for c in (x, y)), strict=True):
                keep.append(9 * _shared(a, b) >= 4 * (len(a) + len(b)))
        at = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts' sets are similar enough, counted exactly.

    Texts of the documents of the pairs alone are moved, as they are smaller than their
    sets, and meet in two joins, which split a document of many pairs.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = only_ids(docs, "id", ids, "id")
    kind = docs.schema["id"].dataType.simpleString()
    both = (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return both.mapInArrow(_linked, f"a {kind}, b {kind}").distinct()


def _signs(batches):
    """Prefixes, each shingle cut to 16 bits."""
    for batch in batches:
        prefix = batch.column("prefix")
        offsets = prefix.offsets
        flat = pa.array(prefix.values.to_numpy(zero_copy_only=False).astype(np.int16))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n"), pa.ListArray.from_arrays(offsets, flat)], names=["id", "n", "sign"]
        )


def _plausible(batches):
    for batch in batches:
        x, y = batch.column("sign_a"), batch.column("sign_b")
        n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        xo, yo = x.offsets.to_numpy(), y.offsets.to_numpy()
        xs, ys = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
        shared = [_shared(xs[xo[i] : xo[i + 1]], ys[yo[i] : yo[i + 1]]) for i in range(len(batch))]
        # Of the 4 (n_a + n_b) / 9 that alike sets share, all but so many may lie behind the prefixes.
        least = (4 * (n_a + n_b) + 8) // 9 - (4 * np.maximum(n_a, n_b) + 4) // 5 + 1
        at = pa.array(np.flatnonzero(np.array(shared, np.int64) >= least))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in _PAIR], names=_PAIR)



def plausible(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    """``pairs`` (a, n_a, b, n_b) without those whose prefixes share too few shingles for alike sets.

    Pairs stay in that share enough of them by 16 bits only.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    kind = sketch.schema["id"].dataType.simpleString()
    signs = only_ids(sketch.select("id", "n", "prefix"), "id", ids, "id").mapInArrow(
        _signs, f"id {kind}, n bigint, sign array<smallint>"
    )
    both = (
        pairs.join(signs.toDF("b", "n_b", "sign_b"), ["b", "n_b"])
        .join(signs.toDF("a", "n_a", "sign_a"), ["a", "n_a"])
        .select(*_PAIR, "sign_a", "sign_b")
    )
    return both.mapInArrow(_plausible, f"a {kind}, n_a bigint, b {kind}, n_b bigint").distinct()


def _may_link(x: Column, y: Column) -> Column:
    """Size and place let a pair with a common shingle there reach the limit, were it the first."""
    need = F.ceil((4 * (x["n"] + y["n"])) / F.lit(9.0))
    return (
        (5 * F.least(x["n"], y["n"]) >= 4 * F.greatest(x["n"], y["n"]))
        & (x["n"] - x["place"] >= need)
        & (y["n"] - y["place"] >= need)
    )


def _pairs_of(met: DataFrame, x: Column, y: Column) -> DataFrame:
    """The distinct pairs of ids and sizes of ``met``."""
    low, high = (f(*(F.struct(z["id"].alias("id"), z["n"].alias("n")) for z in (x, y))) for f in (F.least, F.greatest))
    pairs = met.select(low.alias("low"), high.alias("high"))
    return pairs.select(*(F.col(c).alias(p) for c, p in zip(("low.id", "low.n", "high.id", "high.n"), _PAIR, strict=True))).distinct()


def _centred(rows: DataFrame) -> DataFrame:
    """The rows of buckets of several: how many, the one of the earliest place, and the others each as x."""
    centre = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct("place", "id", "n")).alias("centre"))
    return (
        rows.select("bucket", F.struct("place", "id", "n").alias("x"))
        .join(centre.where("size > 1"), "bucket")
        .where("x <> centre")
    )


def _central_pairs(centred: DataFrame) -> DataFrame:
    """In each bucket every row with the one of the earliest place."""
    x, y = F.col("x"), F.col("centre")
    return _pairs_of(centred.where((x["id"] != y["id"]) & _may_link(x, y)), x, y)


def _remaining_pairs(rows: DataFrame) -> DataFrame:
    """In each bucket with several labels, the pairs of different labels; a null label differs from all.

    One side are the rows without the label of the most central row: all pairs of
    different labels have one.
    """
    several = rows.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("label").alias("known"),
        F.count("*").alias("rows"), F.min(F.struct("place", "id", "n", "label")).alias("centre"),
    ).where("rows > 1 AND (known < rows OR low <> high)").select("bucket", F.col("centre.label").alias("main"))
    mixed = rows.join(several, "bucket").select(
        "bucket", F.struct("place", "id", "n", "label", F.coalesce(F.col("label") == F.col("main"), F.lit(False)).alias("is_main")).alias("x")
    )
    x, y = F.col("x"), F.col("y")
    same = F.coalesce(x["label"] == y["label"], F.lit(False))
    first = F.struct(x["id"], x["n"]) < F.struct(y["id"], y["n"])
    pairs = mixed.where("NOT x.is_main").join(mixed.withColumnRenamed("x", "y"), "bucket")
    return _pairs_of(pairs.where((x["id"] != y["id"]) & ~same & (y["is_main"] | first) & _may_link(x, y)), x, y)


def _documents(pairs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The documents of different labels of pairs of groups."""
    x, y = (
        labelled.select(F.col("group").alias(c), F.col("n").alias(f"n_{c}"), F.col("id").alias(f"id_{c}"), F.col("label").alias(f"label_{c}"))
        for c in ("a", "b")
    )
    return (
        pairs.join(x, ["a", "n_a"]).join(y, ["b", "n_b"])
        .where("label_a <> label_b")
        .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
        .distinct()
    )


def _labelled(ids: DataFrame, links: DataFrame) -> DataFrame:
    return ids.join(components(links), "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")


@shuffles_freed
def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row.

    A row's set are the distinct runs of five words of its whole text (A-Z lower-cased); a
    text of fewer words has one run of all, a null or empty one none and no links. Rows
    link from a Jaccard similarity of 0.8; ``component_id`` is the smallest key that links
    lead to. Rows with one key count as one document with several texts; rows without
    a key get no component. Shingles are compared by hashes of 64 bits.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    tokens, counts = common_shingles(texts)
    sieve = np.zeros(1 << _SIEVE, bool)
    sieve[tokens & U64((1 << _SIEVE) - 1)] = True
    shared = spark.sparkContext.broadcast((tokens, counts, sieve))
    kind = docs.schema[key].dataType.simpleString()
    columns = ", ".join(f"{c} bigint" for c in ("n", "cold", "d1", "d2", "p1", "p2"))
    sketch = stored(texts.mapInArrow(_sketch(shared, "id"), f"id {kind}, {columns}, prefix array<bigint>"), "sketch")
    sets = sketch.where("id IS NOT NULL AND n > 0")
    # Equal sets are one class, classes of equal size and prefix one group.
    classes = stored(
        sets.groupBy("n", "d1", "d2", "p1", "p2").agg(F.min("id").alias("id")), "classes"
    )
    groups = classes.groupBy("n", "p1", "p2").agg(F.min("id").alias("group"))
    members = stored(classes.join(groups, ["n", "p1", "p2"]).select("group", "id", "n"), "members")
    heads = members.select("group").distinct()
    shingles = sets.select("id", "n", "cold", F.posexplode("prefix").alias("place", "bucket"))
    # A shingle that is not common is in few documents, so its bucket fits a row; the
    # many that only one document has end here. Common ones are never brought together.
    rare = (
        shingles.where("place < cold").groupBy("bucket").agg(F.collect_list(F.struct("id", "n", "place")).alias("rows"))
        .where(F.size("rows") > 1).select("bucket", F.inline("rows"))
    )
    common = shingles.where("place >= cold").select("bucket", "id", "n", "place")
    rows = stored(
        rare.unionByName(common).join(heads.withColumnRenamed("group", "id"), "id", "left_semi").distinct(), "buckets"
    )
    inside = members.where("id <> group").select(F.col("group").alias("a"), F.col("id").alias("b"))
    centred = stored(_centred(rows), "centred")
    met = stored(plausible(stored(_central_pairs(centred), "met"), sets), "met")
    first = stored(met.select("a", "b").unionByName(inside).distinct(), "pairs")
    links = stored(verified(first, texts), "links")
    # From here on also documents, not groups alone. A group without one label differs from all, itself included.
    labelled = stored(_labelled(members, links), "labels")
    labels = labelled.groupBy(F.col("group").alias("id"), "n").agg(
        F.when(F.min("label") == F.max("label"), F.min("label")).alias("label")
    )
    others = centred.where("size > 2").select("bucket", "x.*").join(labels, ["id", "n"])
    more = plausible(stored(_remaining_pairs(others), "met"), sets)
    itself = labels.where("label IS NULL").select(*(F.col(c).alias(p) for c, p in zip(("id", "n") * 2, _PAIR, strict=True)))
    pairs = _documents(met.unionByName(more).unionByName(itself), labelled)
    second = stored(pairs.join(first, ["a", "b"], "left_anti"), "pairs")
    links = stored(links.unionByName(verified(second, texts)), "links")
    found = classes.select("n", "d1", "d2", "p1", "p2", "id")
    final = _labelled(found, links).withColumnRenamed("label", "component_id").drop("id")
    # Rows of one key but different texts carry each other's component.
    return (
        sketch.select(F.col("id").alias(key), "n", "d1", "d2", "p1", "p2")
        .join(final, ["n", "d1", "d2", "p1", "p2"], "left")
        .select(
            key,
            F.col("n").alias("n_shingles"),
            F.when(F.col(key).isNotNull(), F.coalesce("component_id", key)).alias("component_id"),
        )
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest key.

    Of several rows with this key that with the smallest text stays. Rows without a key
    stay, as nothing links to them. All columns are kept.
    """
    found = stored(near_duplicates(docs, key, text), "components")
    others = found.where(F.col(key) > F.col("component_id")).select(key).distinct()
    kept = without_ids(docs, key, others)
    several = stored(found.groupBy(key).count().where(F.col(key).isNotNull() & (F.col("count") > 1)).select(key), "several")
    if several.isEmpty():
        return kept
    first = Window.partitionBy(key).orderBy(text)
    one = (
        kept.join(several, key, "left_semi")
        .withColumn("__row", F.row_number().over(first))
        .where("__row = 1")
        .drop("__row")
    )
    return kept.join(several, key, "left_anti").unionByName(one)
