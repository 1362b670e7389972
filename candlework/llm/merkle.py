"""A manifest of a dataset as a Merkle tree, with a proof for every row.

Leaves are numbered along each source, and a node is labelled with the interval of leaf
numbers that it covers: a node lies below another if its interval is within the other's,
and its siblings cover what is left of its parent's interval without its own. The
intervals of a level are of one width, which buckets them: a join on the bucket attaches
to each node the ancestor that contains it, with all that is known of that one's own
ancestors.

Nodes are kept as broods, a row for each parent with the labels of its children, of which
there are ``FAN`` at most. The trees of all sources are built together, a job for each
level; their roots are the leaves of one more tree. Column expressions and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlework.session import stored

FAN = 16
#: The fields of a leaf, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

#: A tree's broods from its leaves up, each with the number of leaves that one covers.
Broods = list[tuple[int, DataFrame]]


def leaf_digest(text: Column | None = None) -> Column:
    """Of a row of documents: each field as ``-`` if null, else its bytes, ``:`` and the value."""
    values = {c: F.col(c).cast("string") for c in FIELDS}
    if text is not None:
        values["text"] = text
    written = [
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values.values()
    ]
    return F.sha2(F.concat(*written), 256)


def lower_cased(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _bucket(width: int) -> Column:
    return F.call_function("div", F.col("lo"), F.lit(width))


def _placed(leaves: DataFrame, *order: str) -> DataFrame:
    """``leaves`` with ``lo``, their number in their ``tree`` in this order, and ``n``, the leaves of it.

    A tree may hold any share of all rows: rows are sorted over all partitions, and each
    partition's first number follows from the numbers of rows in those before it.
    """
    keys = ["tree", *order, "reading"]
    # Written, as the bounds of the ranges must not change between the passes below.
    ranged = stored(
        leaves.withColumn("reading", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("position", F.monotonically_increasing_id())
        .drop("reading"),
        "leaves",
    )
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, and one more per tree.
    runs = (
        ranged.groupBy("tree", "part")
        .agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("rows"))
        .select(
            "tree",
            "part",
            (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(tree).alias("n"),
        )
    )
    return (
        ranged.join(runs, ["tree", "part"])
        .withColumn("lo", F.col("position") + F.col("shift"))
        .drop("part", "position", "shift")
    )


def _brood(nodes: DataFrame, width: int, *more: str) -> DataFrame:
    """The parents of ``nodes``: tree, n, the interval [lo, hi), the children's labels and the digest.

    A tree of one leaf has that as its root; it is kept as a brood all the same.
    """
    kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", *more)))
    joined = F.sha2(F.array_join("kids.digest", ""), 256)
    return (
        nodes.groupBy("tree", _bucket(width).alias("bucket"))
        .agg(F.min("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), kids.alias("kids"))
        .select("tree", "n", "lo", "hi", "kids", F.when(F.col("n") > 1, joined).otherwise(F.col("kids.digest")[0]).alias("digest"))
    )


def build(placed: DataFrame, *more: str) -> Broods:
    """The broods of ``placed`` leaves (tree, n, lo, digest); ``more`` columns stay with the leaves."""
    nodes, width = placed.withColumn("hi", F.col("lo") + 1), FAN
    broods = [(width, stored(_brood(nodes, width, *more), "broods"))]
    largest = broods[0][1].agg(F.max("n")).first()[0] or 0
    while largest > width:
        nodes = broods[-1][1].where(F.col("n") > width).select("tree", "n", "lo", "hi", "digest")
        width *= FAN
        broods.append((width, stored(_brood(nodes, width), "broods")))
    return broods


def _tops(width: int, brood: DataFrame) -> DataFrame:
    """Broods whose parent is the root of its tree."""
    return brood.where(F.col("n") <= width)


def roots(broods: Broods) -> DataFrame:
    """``tree, digest``."""
    out = None
    for width, brood in broods:
        top = _tops(width, brood).select("tree", "digest")
        out = top if out is None else out.unionByName(top)
    return out


def _siblings(lo: Column, hi: Column, kids: Column) -> Column:
    """What the parent's interval holds before and after [lo, hi), as joined digests."""

    def joined(outside) -> Column:
        return F.array_join(F.transform(F.filter(kids, outside), lambda k: k["digest"]), "")

    return F.struct(
        joined(lambda k: k["hi"] <= lo).alias("before"), joined(lambda k: k["lo"] >= hi).alias("after")
    )


def attach(broods: Broods, above: DataFrame) -> DataFrame:
    """The lowest broods with ``path``: the siblings of each ancestor, from the brood's parent up.

    ``above`` has a row for each tree: its ``path`` beyond the tree's root, and any other
    columns, which are passed on.
    """
    more = [c for c in above.columns if c not in ("tree", "path")]
    upper, height = None, 0
    for width, brood in reversed(broods):
        found = _tops(width, brood).join(above, "tree")
        if upper is not None:
            parent = upper.withColumn("bucket", _bucket(height)).alias("parent")
            inside = (F.col("parent.lo") <= F.col("own.lo")) & (F.col("own.hi") <= F.col("parent.hi"))
            step = _siblings(F.col("own.lo"), F.col("own.hi"), F.col("parent.kids"))
            below = (
                brood.where(F.col("n") > width)
                .withColumn("bucket", _bucket(height))
                .alias("own")
                .join(parent, ["tree", "bucket"])
                .where(inside)
                .select(
                    "tree", *[F.col(f"own.{c}") for c in ("n", "lo", "hi", "kids", "digest")],
                    F.concat(F.array(step), F.col("parent.path")).alias("path"), *more,
                )
            )
            found = found.unionByName(below)
        upper, height = stored(found, "attached"), width
    return upper


def _leaves(attached: DataFrame, *more: str) -> DataFrame:
    """The leaves with their whole ``path``, that in their own brood included."""
    one = attached.select("tree", "n", "kids", "path", *more, F.explode("kids").alias("kid"))
    own = F.array(_siblings(F.col("kid.lo"), F.col("kid.hi"), F.col("kids")))
    path = F.when(F.col("n") > 1, F.concat(own, F.col("path"))).otherwise(F.col("path"))
    return one.select("tree", "kid", path.alias("path"), *more)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: its leaf, the roots, and the proof that leads to them.

    Needs the columns ``FIELDS``; others are left out. Leaves of a source are in order of
    doc_id, rows without an id first, repeated ids by their digests; a null source is a
    source of its own and comes first. ``tampered``, a column over ``docs``, is the digest
    that is to be checked in place of the leaf's where it is not null. Returns ``doc_id,
    leaf, subroot, root, proof_sha256, folded_root, verified``. Empty ``docs`` have no rows
    and no root.
    """
    changed = F.lit(None).cast("string") if tampered is None else tampered
    # A null source as the empty key, which sorts before all others.
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = docs.select(key.alias("tree"), "doc_id", leaf_digest().alias("digest"), changed.alias("tampered"))
    # Stored, as the sort reads its rows twice: the texts are hashed once.
    broods = build(_placed(stored(leaves, "digests"), "doc_id", "digest"), "doc_id", "tampered")
    subroots = stored(roots(broods).withColumnsRenamed({"tree": "source"}).withColumn("tree", F.lit("")), "subroots")
    top = build(_placed(subroots, "source"), "source")
    beyond = roots(top).select(
        "tree", F.array().cast("array<struct<before: string, after: string>>").alias("path"), F.col("digest").alias("root")
    )
    above = _leaves(attach(top, beyond), "root").select(
        F.col("kid.source").alias("tree"), "path", F.col("kid.digest").alias("subroot"), "root"
    )
    found = _leaves(attach(broods, stored(above, "above")), "subroot", "root")

    def folded(path: Column) -> Column:
        start = F.coalesce("kid.tampered", "kid.digest")
        return F.aggregate(path, start, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))

    def proof(path: Column) -> Column:
        return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)

    # A lambda, so that the path is put together once for both.
    row = F.transform(
        F.array("path"),
        lambda path: F.struct(
            F.col("kid.doc_id").alias("doc_id"), F.col("kid.digest").alias("leaf"), "subroot", "root",
            proof(path).alias("proof_sha256"), folded(path).alias("folded_root"),
        ),
    )
    return found.select(F.inline(row)).withColumn("verified", F.col("folded_root") == F.col("root"))
