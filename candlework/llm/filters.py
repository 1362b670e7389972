"""Filters of a fixed number of bits, which keep what may be needed and most else out.

They only save work: whatever passes is joined exactly afterwards. Their size does not
grow with the data, so they may be collected and broadcast; over very many keys they
let more pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the number of bits: 2 MB.
BITS = 24


def bit_words(places: DataFrame, place: str) -> DataFrame:
    """One row per 64-bit word that has a bit set: at most 2 ** (BITS - 6) rows."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(place).bitwiseAND(63).cast("int"))
    return places.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def hash_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of two places of every 64-bit hash, for ``may_contain``."""
    mask = (1 << BITS) - 1
    places = hashes.select(
        F.explode(
            F.array(
                F.col(column).bitwiseAND(mask), F.shiftrightunsigned(column, BITS).bitwiseAND(mask)
            )
        ).alias("place")
    )
    out = np.zeros(1 << (BITS - 6), np.int64)
    for row in bit_words(places, "place").toLocalIterator():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def may_contain(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places in ``hashes`` of those that may have been put into the filter."""
    mask, six, low = np.uint64((1 << BITS) - 1), np.uint64(6), np.uint64(63)
    place = hashes & mask
    at = np.flatnonzero((bits[place >> six] >> (place & low)) & np.uint64(1))
    place = (hashes[at] >> np.uint64(BITS)) & mask
    return at[np.flatnonzero((bits[place >> six] >> (place & low)) & np.uint64(1))]


def only_ids(df: DataFrame, key: str, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose key may be among ``ids``, found without moving ``df``."""

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << BITS))

    words = bit_words(ids.select(place(column).alias("place")), "place")
    joined = df.withColumn("__place", place(key)).join(
        F.broadcast(words),
        (F.shiftright("__place", 6) == words["word"])
        & (F.getbit("bits", F.col("__place").bitwiseAND(63)) == 1),
        "left_semi",
    )
    return joined.drop("__place")


def without_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is not among the keys of ``ids``; rows with a null key stay.

    Only rows that the filter takes for one of them are moved to be compared.
    """
    words = bit_words(ids.select(F.pmod(F.xxhash64(key), F.lit(1 << BITS)).alias("place")), "place")
    flagged = df.withColumn("__place", F.pmod(F.xxhash64(key), F.lit(1 << BITS))).join(
        F.broadcast(words.withColumnsRenamed({"word": "__word", "bits": "__bits"})),
        F.shiftright("__place", 6) == F.col("__word"),
        "left",
    )
    may = F.coalesce(F.getbit("__bits", F.col("__place").bitwiseAND(63)) == 1, F.lit(False))
    rest = flagged.where(~may).drop("__place", "__word", "__bits")
    there = flagged.where(may).drop("__place", "__word", "__bits")
    return rest.unionByName(there.join(ids.select(key).distinct(), key, "left_anti"))
