"""Quality rules: measures of a whole text, and lines that too many documents share.

Column expressions and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlework.session import stored

#: A document of fewer words fails.
MIN_WORDS = 50
#: A document with more than this share of its words in repeated windows fails.
MAX_REPEATED = 0.5
#: A line is common if at least so many documents of a host have it ...
MIN_DOCUMENTS = 10
#: ... and at least this share of the host's documents.
MIN_SHARE = 0.1
#: A document that loses more than this share of its words with its common lines is rejected.
MAX_LOST = 0.5

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


# Characters are replaced one after the other, which goes over bytes; translate() looks up
# each character of the text in a table.


def _replaced(text: Column, characters: str, by: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def _one_space(text: Column) -> Column:
    """``text`` with a space for any white space."""
    return _replaced(text, SPACES[1:], " ")


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text, in order."""
    return F.array_remove(F.split(_one_space(text), " "), "")


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), _has_word)


def line_key(line: Column) -> Column:
    """Hash of a line in lower case, its words one space apart."""
    return F.xxhash64(F.array_join(words_of(F.lower(line)), " "))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it.

    Spark may put the expression of a column in place of its name, also within a loop
    over an array; the variable of a lambda stays.
    """
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside windows of three words that occur twice or more in the text."""

    def of_words(w):
        last = F.greatest(F.size(w) - 2, F.lit(0))
        hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return _bound(F.slice(hashes, 1, last), of_hashes)

    def of_hashes(h):
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        # Most texts repeat nothing, which is cheaper to see than where.
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(F.array_sort(placed)))

    return _bound(words, of_words)


def _covered(ordered: Column) -> Column:
    # Equal windows are neighbours. Each place of one covers three words from there,
    # of which those up to the end of the last are counted already.
    def places(o):
        twice = F.filter(o, lambda x, i: (F.get(o, i - 1)["h"] == x["h"]) | (F.get(o, i + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    return F.aggregate(
        _bound(ordered, places),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n")),
        lambda a: a["n"],
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    A null text has no words and no lines.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    dup_lines = _bound(_lines(t), lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))
    return (
        docs.withColumn("__words", words_of(t))
        .withColumn("n_words", F.size("__words").cast("long"))
        .withColumn("word_chars", F.length(_replaced(t, SPACES, "")).cast("long"))
        .withColumn("n_symbols", (F.length(t) - F.length(_replaced(t, SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", dup_lines.cast("long"))
        .withColumn("n_repeat_words", _repeated_words(F.col("__words")).cast("long"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEATED) * F.col("n_words")),
        )
        .drop("__words")
    )


def common_lines(
    docs: DataFrame,
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """``host``, ``line`` (hash) and ``documents`` of the lines above the limits.

    A document is a distinct text: exact copies count once, under whatever ids. Rows
    without a text are not counted; rows without a host form one of their own.
    """
    texts = docs.where("text IS NOT NULL").select(
        F.coalesce(host, F.lit("")).alias("host"),
        F.xxhash64("text", F.length("text")).alias("content"),
        "text",
    )
    # Counted over distinct contents of a host: copies of one text are one document.
    hosts = texts.groupBy("host", "content").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("total"))
    lines = (
        texts.select("host", "content", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), line_key))).alias("line"))
        .distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("documents"))
        .where(F.col("documents") >= min_documents)
    )
    return lines.join(hosts, "host").where(F.col("documents") >= min_share * F.col("total")).drop("total")


def _host_lines(common: DataFrame) -> DataFrame:
    """The common lines of each host in one row.

    As each is in min_share of the host's documents at least, they are at most
    1 / min_share times the lines of an average document.
    """
    return common.groupBy("host").agg(F.collect_set("line").alias("common"))


def _without(common: Column) -> Column:
    """``lost``, the words in common lines, and ``rest``, the text without them; null for a null text."""

    def flagged(line):
        return F.struct(
            line.alias("line"), (_has_word(line) & F.array_contains(common, line_key(line))).alias("common")
        )

    def parts(lines):
        words = F.aggregate(
            F.filter(lines, lambda x: x["common"]), F.lit(0), lambda n, x: n + F.size(words_of(x["line"]))
        )
        rest = F.transform(F.filter(lines, lambda x: ~x["common"]), lambda x: x["line"])
        return F.struct(words.cast("long").alias("lost"), F.array_join(rest, "\n").alias("rest"))

    return _bound(F.transform(F.split("text", "\n"), flagged), parts)


def judged(docs: DataFrame, host: str = "source", max_lost: float = MAX_LOST, **limits) -> DataFrame:
    """``docs`` with their measures, ``n_common_words``, ``clean_text`` and ``kept``.

    ``kept`` is false where the base rules fail or where more than ``max_lost`` of the
    words stand in common lines; ``clean_text`` is the text without those lines (a null
    text stays null). No row is lost or doubled, whatever its id.
    """
    # Written, so that the size is known when the join is planned.
    common = stored(_host_lines(common_lines(docs, host, **limits)), "common")
    with_common = (
        docs.withColumn("__host", F.coalesce(host, F.lit("")))
        .join(common.withColumnRenamed("host", "__host").withColumnRenamed("common", "__common"), "__host", "left")
        .drop("__host")
    )
    measured = measures(with_common)
    known = F.coalesce("__common", F.array().cast("array<bigint>"))
    has = F.size(known) > 0
    cut = measured.withColumn("__cut", F.when(has, _without(known)))
    return (
        cut.withColumn("n_common_words", F.coalesce("__cut.lost", F.lit(0).cast("long")))
        .withColumn("clean_text", F.when(has, F.col("__cut.rest")).otherwise(F.col("text")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_common_words") <= max_lost * F.col("n_words")))
        .drop("__common", "__cut")
    )


def quality_digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_common_words",
    )

