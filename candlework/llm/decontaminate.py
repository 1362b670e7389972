"""Benchmark passages in documents: a prefix-filtered set join on shingles.

A window of an item is a set of shingles, all of which a document must contain at the
right distances. As nothing may be missing, one shingle of each window is a sufficient
prefix: its rarest over all documents. Documents are joined on it, the place of the
shingle in the window bounds where the window may begin and end, and the words there
are compared exactly. A first pass counts the shingles; only then are the places of
those of the prefix written down, with the words that a window there can have.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlework.llm import filters
from candlework.llm.text import ALPHANUMERIC, BLOCK_BYTES, Words, blocks, window_hashes, words
from candlework.session import stored

WINDOW = 10
SHINGLE = 5

_WINDOWS = "item_id string, words string, n int, shingles array<struct<offset: int, size: int, token: bigint>>"
_HITS = "n_words bigint, hits array<struct<at: int, low: int, token: bigint, context: string>>"
_HIT = pa.list_(
    pa.struct([("at", pa.int32()), ("low", pa.int32()), ("token", pa.int64()), ("context", pa.string())])
)


def _windows(window: int, shingle: int):
    def run(batches):
        for batch in batches:
            ids, items, texts, sizes, shingles = batch.column("item_id"), [], [], [], []
            w = words(batch.column("text"), ALPHANUMERIC)
            h = w.hashes()
            for d, n in enumerate(w.counts().tolist()):
                length = min(window, n)
                size = min(shingle, length)
                a = int(w.first[d])
                for i in range(a, a + n - length + 1 if n else a):
                    items.append(ids[d].as_py())
                    texts.append(b" ".join(w.text(w.start[j], w.end[j]) for j in range(i, i + length)).decode())
                    sizes.append(length)
                    tokens = window_hashes(h[i : i + length], size).view(np.int64).tolist()
                    shingles.append([{"offset": o, "size": size, "token": t} for o, t in enumerate(tokens)])
            kind = pa.list_(pa.struct([("offset", pa.int32()), ("size", pa.int32()), ("token", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()),
                 pa.array(shingles, kind)],
                names=["item_id", "words", "n", "shingles"],
            )

    return run


def _runs(w: Words, h: np.ndarray, bits, size: int):
    """The runs of ``size`` words that may be in the filter: their hashes, first words and documents."""
    runs = window_hashes(h, size)
    at = filters.may_contain(bits, runs)
    doc = np.searchsorted(w.first, at, side="right") - 1
    inside = at + size <= w.first[doc + 1]
    return runs.view(np.int64)[at[inside]], at[inside], doc[inside]


def _frequencies(bits, sizes: list[int], text: str):
    """How often each shingle of the windows occurs in a block."""

    def run(batches):
        for batch in batches:
            column = batch.column(text)
            for a, b in blocks(column, BLOCK_BYTES):
                w = words(column.slice(a, b - a), ALPHANUMERIC)
                h = w.hashes()
                every = [_runs(w, h, bits.value, size)[0] for size in sizes]
                found, n = np.unique(np.concatenate([np.zeros(0, np.int64), *every]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n, pa.int64())], names=["token", "n"])

    return run


def _hits(shared, keep: list[str], text: str):
    """The places of prefix shingles, each with the words that a window around it may have."""

    def of_block(column):
        bits, reach = shared.value
        w = words(column, ALPHANUMERIC)
        h = w.hashes()
        out = [[] for _ in range(len(column))]
        for size, before, after in reach:
            for token, p, d in zip(*(x.tolist() for x in _runs(w, h, bits, size)), strict=True):
                first = int(w.first[d])
                low, high = max(first, p - before), min(int(w.first[d + 1]), p + after)
                context = b" ".join(w.text(a, b) for a, b in zip(w.start[low:high], w.end[low:high], strict=True))
                out[d].append({"at": p - first, "low": low - first, "token": token, "context": context.decode()})
        return w.counts(), out

    def run(batches):
        for batch in batches:
            column = batch.column(text)
            for a, b in blocks(column, BLOCK_BYTES):
                counts, found = of_block(column.slice(a, b - a))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [pa.array(counts, pa.int64()), pa.array(found, _HIT)],
                    names=[*keep, "n_words", "hits"],
                )

    return run


def find_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """One row per row of ``docs``: what benchmark windows occur in its whole text.

    Both need an id (``doc_id``, ``item_id``) and ``text``; other columns are left out.
    Words are runs of letters and digits after lower-casing A-Z. Returns ``doc_id``,
    ``n_words``, ``n_hit`` (words inside any occurrence), ``n_items``, ``item_ids``
    (sorted as strings) and ``spans`` (start word and number of words of each
    occurrence). A null or empty text has no words; an empty benchmark hits nothing.
    Repeated rows are judged one by one. Items without an id mark words but are not
    counted or listed; items that share an id count as one.
    """
    spark = docs.sparkSession
    all_windows = stored(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(_windows(window, shingle), _WINDOWS)
        .withColumn("window", F.md5("words")),
        "windows",
    )
    of_items = all_windows.where("item_id IS NOT NULL").select("window", "item_id").distinct()
    windows = all_windows.groupBy("window").agg(
        F.any_value("words").alias("words"), F.any_value("n").alias("n"), F.any_value("shingles").alias("shingles")
    )
    shingles = windows.select("window", "words", "n", F.explode("shingles").alias("s")).select(
        "window", "words", "n", "s.*"
    )
    share = spark.sparkContext.broadcast
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.select("text").mapInArrow(
        _frequencies(share(filters.hash_filter(shingles, "token")), sizes, "text"), "token bigint, n bigint"
    )
    frequency = counted.groupBy("token").agg(F.sum("n").alias("rows"))
    # The order by rarity is known before any place is written.
    prefix = stored(
        shingles.join(frequency, "token", "left")
        .groupBy("window")
        .agg(
            F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "token", "offset", "size")).alias("p"),
            F.any_value("words").alias("words"),
            F.any_value("n").alias("n"),
        )
        .where("p.rows > 0")
        .select("window", "words", "n", F.col("p.token").alias("token"), F.col("p.offset").alias("offset"),
                F.col("p.size").alias("size")),
        "prefix",
    )
    # For each size of shingles, the words that a window has before and from its place on.
    bounds = prefix.groupBy("size").agg(F.max("offset").alias("before"), F.max(F.col("n") - F.col("offset")).alias("after"))
    reach = sorted((r["size"], r["before"], r["after"]) for r in bounds.collect())
    # The row number keeps repeated ids apart; it is fixed by being written.
    rows = stored(
        texts.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(_hits(share((filters.hash_filter(prefix, "token"), reach)), ["doc_id", "row"], "text"),
                    f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row bigint, {_HITS}"),
        "hits",
    )
    hits = rows.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    prefix = prefix.drop("size")
    begin = F.col("at") - F.col("offset")
    there = F.slice(F.split("context", " "), F.greatest(begin - F.col("low"), F.lit(0)) + 1, F.col("n"))
    found = (
        hits.join(prefix, "token")
        .where((begin >= F.col("low")) & (F.array_join(there, " ") == F.col("words")))
        .select("row", "window", begin.alias("start"), "n")
        .distinct()
    )
    found = stored(found, "found")
    spans = found.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"))
    items = (
        found.select("row", "window").distinct().join(of_items, "window")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["n"]).alias("end"),
            (a["total"] + F.greatest(s["start"] + s["n"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("total"),
        ),
        lambda a: a["total"],
    )
    none = F.array().cast("array<string>")
    return (
        rows.select("row", "doc_id", "n_words")
        .join(spans, "row", "left")
        .join(items, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
            F.size(F.coalesce("item_ids", none)).cast("long").alias("n_items"),
            F.coalesce("item_ids", none).alias("item_ids"),
            "spans",
        )
    )


def decontamination_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
