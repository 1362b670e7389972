"""Language of every word, smoothed to spans, and of the whole text.

The script of a word narrows the languages it may be in; byte n-grams and the word
itself score the rest; a Viterbi pass with a penalty for each switch labels the words.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.llm.text import LOWER, U64, blocks, mix, span_hashes, words

#: Expected number of training rows of each language, drawn by a hash of the id.
SAMPLE_ROWS = 1000
BUCKETS = 1 << 16
#: Nats that a change of language costs.
SWITCH = 12.0
#: A language may use a script if at least this share of its training words does.
SCRIPT_SHARE = 0.001
OUTSIDE = -50.0

_LETTERS = np.zeros(256, bool)
_LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True

#: Scripts by the first bytes of their characters; ASCII and other Latin letters are 1.
SCRIPTS = ("none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "thai", "kana", "han", "hangul", "other")
_SCRIPT = np.zeros(256, np.uint8)
_SCRIPT[0x61:0x7B] = _SCRIPT[0xC3:0xCD] = 1
_SCRIPT[0xCD:0xD0] = 2
_SCRIPT[0xD0:0xD5] = 3
_SCRIPT[0xD6:0xD8] = 4
_SCRIPT[0xD8:0xDC] = 5
_SCRIPT[0xE0] = 6
_SCRIPT[0xE3] = 8
_SCRIPT[0xE4:0xEA] = 9
_SCRIPT[0xEA:0xEE] = 10
_SCRIPT[0xF0:0xF5] = 11


@dataclass
class Model:
    """``scores``: per n-gram bucket, ``word_scores``: per word bucket, a row for each language."""

    languages: list[str]
    scores: np.ndarray
    word_scores: np.ndarray
    allowed: np.ndarray


def trained_on(doc_id: Column) -> Column:
    """Rows that may be learned from."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def _features(column: pa.Array):
    """Words; the n-gram bucket of each byte in a word; the bucket and script of each word."""
    w = words(column, _LETTERS, LOWER)
    data = np.where(_LETTERS[w.data], w.data, 0x20).astype(U64)
    before, after = np.full(len(data), 0x20, U64), np.full(len(data), 0x20, U64)
    before[1:], after[:-1] = data[:-1], data[1:]
    cut = w.offsets[1:-1]
    before[cut[cut < len(data)]] = 0x20
    after[(cut - 1)[cut > 0]] = 0x20
    gram = mix((before << U64(16)) | (data << U64(8)) | after) >> U64(48)
    bucket = span_hashes(w.data, w.start, w.end) >> U64(48)
    # Thai shares its first byte with the scripts of India.
    script = _SCRIPT[w.data]
    thai = (w.data[:-1] == 0xE0) & (w.data[1:] >= 0xB8) & (w.data[1:] < 0xBC)
    script[:-1][thai] = 7
    of_word = np.zeros(len(w.start), np.uint8)
    if len(w.start):
        edges = np.column_stack([w.start, w.end]).ravel()
        of_word = np.maximum.reduceat(np.append(script, 0), edges)[::2]
    return w, gram.astype(np.int64), bucket.astype(np.int64), of_word


_GRAM, _WORD, _SCRIPT_OF = 0, 1, 2


def _count(batches):
    for batch in batches:
        langs = batch.column("lang")
        column = batch.column("text")
        out = []
        for a, b in blocks(column):
            w, gram, bucket, script = _features(column.slice(a, b - a))
            names = langs.slice(a, b - a).to_pylist()
            inside = np.zeros(len(w.data) + 1, np.int64)
            inside[w.start] += 1
            np.add.at(inside, w.end, -1)
            byte = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
            byte_doc = np.searchsorted(w.offsets, byte, side="right") - 1
            word_doc = np.repeat(np.arange(len(names)), w.counts())
            codes = {n: np.array([m == n for m in names]) for n in set(names)}
            for name, own in codes.items():
                for kind, values in (
                    (_GRAM, gram[byte[own[byte_doc]]]), (_WORD, bucket[own[word_doc]]), (_SCRIPT_OF, script[own[word_doc]]),
                ):
                    found, n = np.unique(values, return_counts=True)
                    out.append((name, kind, found.astype(np.int64), n))
        lengths = [len(f) for _, _, f, _ in out]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array([o[0] for o in out], object), lengths), pa.string()),
                pa.array(np.repeat([o[1] for o in out], lengths) if out else [], pa.int32()),
                pa.array(np.concatenate([o[2] for o in out]) if out else [], pa.int64()),
                pa.array(np.concatenate([o[3] for o in out]) if out else [], pa.int64()),
            ],
            names=["lang", "kind", "bucket", "n"],
        )


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Counts of about ``sample_rows`` documents of each language; None if there are none.

    Rows without id, language or text are not learned from. The counts that come to the
    driver have a fixed number of buckets for each language.
    """
    rows = docs.where(trained_on(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return None
    rate = F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, sample_rows / n)])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < rate[F.col("lang")] * (1 << 30)
    counts = (
        rows.where(drawn).select("lang", "text")
        .mapInArrow(_count, "lang string, kind int, bucket bigint, n bigint")
        .groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted(totals)
    code = {lang: i for i, lang in enumerate(languages)}
    lang = np.array([code[x] for x in counts["lang"].to_pylist()], np.int64)
    kind, bucket, n = (counts[c].to_numpy() for c in ("kind", "bucket", "n"))
    tables = []
    for k in (_GRAM, _WORD):
        own = kind == k
        table = np.full((len(languages), BUCKETS), 0.1)
        table[lang[own], bucket[own]] += n[own]
        tables.append(np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))
    own = kind == _SCRIPT_OF
    scripts = np.zeros((len(SCRIPTS), len(languages)))
    scripts[bucket[own], lang[own]] = n[own]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, tables[0], tables[1], allowed)


def word_scores(m: Model, column: pa.Array):
    """The words of the texts, and of each word the score of every language."""
    w, gram, bucket, script = _features(column)
    out = np.zeros((len(w.start), len(m.languages)), np.float32)
    sums = np.zeros(len(gram) + 1)
    for i in range(len(m.languages)):
        np.cumsum(m.scores[i][gram], dtype=np.float64, out=sums[1:])
        out[:, i] = sums[w.end] - sums[w.start]
        out[:, i] += m.word_scores[i][bucket]
    may = m.allowed[script]
    may |= ~may.any(axis=1, keepdims=True)
    out[~may] = OUTSIDE + out.min(axis=1, initial=0.0)[np.nonzero(~may)[0]]
    return w, out


def smooth(scores: np.ndarray, begins: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The labels of the best path, where each change costs ``switch`` except at ``begins``.

    One long chain, cut into pieces that go on side by side: each piece is solved for
    every state before it, then the pieces are joined, then each is solved again from
    the state that is right.
    """
    n, k = scores.shape
    if n == 0 or k == 1:
        return np.zeros(n, np.int64)
    pieces = max(1, min(1024, n // 64))
    steps = -(-n // pieces)
    padded = np.zeros((steps * pieces, k), np.float32)
    padded[:n] = scores
    cost = np.full(steps * pieces, switch, np.float32)
    cost[:n][begins[begins < n]] = 0
    padded = np.ascontiguousarray(padded.reshape(pieces, steps, k).transpose(1, 0, 2))
    cost = np.ascontiguousarray(cost.reshape(pieces, steps).T)[:, :, None]
    far = np.where(np.eye(k, dtype=bool), 0.0, -np.inf).astype(np.float64)
    value = np.broadcast_to(far, (pieces, k, k)).copy()
    for t in range(steps):
        best = value.max(axis=2, keepdims=True) - cost[t][:, :, None]
        np.maximum(value, best, out=value)
        value += padded[t][:, None, :]
    before = np.zeros((pieces, k))
    for p in range(1, pieces):
        before[p] = (before[p - 1][:, None] + value[p - 1]).max(axis=0)
        before[p] -= before[p].max()
    value = before.copy()
    switched = np.zeros((steps, pieces, k), bool)
    source = np.zeros((steps, pieces), np.int64)
    rows = np.arange(pieces)
    for t in range(steps):
        source[t] = value.argmax(axis=1)
        other = value[rows, source[t]][:, None] - cost[t]
        np.greater(other, value, out=switched[t])
        value = np.maximum(value, other) + padded[t]
    last = np.broadcast_to(np.arange(k), (pieces, k)).copy()
    for t in range(steps - 1, -1, -1):
        last = np.where(switched[t][rows[:, None], last], source[t][:, None], last)
    ends = np.zeros(pieces, np.int64)
    ends[-1] = value[-1].argmax()
    for p in range(pieces - 1, 0, -1):
        ends[p - 1] = last[p, ends[p]]
    out = np.zeros((steps, pieces), np.int64)
    for t in range(steps - 1, -1, -1):
        out[t] = ends
        ends = np.where(switched[t][rows, ends], source[t], ends)
    return out.T.ravel()[:n]


_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _label(model, keep, switch):
    def of_block(m, column):
        w, scores = word_scores(m, column)
        label = smooth(scores, w.first[:-1], switch)
        size = (w.end - w.start).astype(np.float64)
        doc = np.repeat(np.arange(len(column)), w.counts())
        k = len(m.languages)
        weight = np.bincount(doc * k + label, size, len(column) * k).reshape(-1, k)
        total = weight.sum(axis=1)
        # Code points before each byte.
        chars = np.append(0, np.cumsum((w.data & 0xC0) != 0x80))
        first = np.ones(len(label), bool)
        first[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(first)
        until = np.append(at, len(label))[1:] - 1
        spans = [[] for _ in range(len(column))]
        base = chars[w.offsets[:-1]]
        for d, i, a, b in zip(
            doc[at].tolist(), label[at].tolist(), chars[w.start[at]].tolist(), chars[w.end[until]].tolist(), strict=True
        ):
            spans[d].append({"lang": m.languages[i], "start": a - int(base[d]), "end": b - int(base[d])})
        best = weight.argmax(axis=1)
        lang = [m.languages[i] if n else "und" for i, n in zip(best.tolist(), total.tolist(), strict=True)]
        share = weight[np.arange(len(column)), best] / np.maximum(total, 1)
        return lang, share, spans

    def run(batches):
        m = Model(*model.value)
        for batch in batches:
            column = batch.column("text")
            for a, b in blocks(column):
                lang, share, spans = of_block(m, column.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in keep]
                    + [pa.array(lang, pa.string()), pa.array(share, pa.float64()), pa.array(spans, _SPANS)],
                    names=[*keep, "lang_pred", "score", "spans"],
                )

    return run


def identify(docs: DataFrame, model: Model | None, switch: float = SWITCH) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` (lang, start, end in code points) of each row.

    ``lang_pred`` has most of the letters, ``score`` is its share of them. Null texts and
    texts without a letter are ``und`` with score 0 and no spans, as are all without a
    model. Repeated rows and null ids stay as they are.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    new = "lang_pred string, score double, spans array<struct<lang: string, start: int, end: int>>"
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(f"letters boolean, {new}").fields])
    rows = docs.select("doc_id", letters.alias("letters"), "text")
    none = F.array().cast(schema["spans"].dataType)
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("spans"))
    # Without the class, which a broadcast names only: workers need no copy of the package.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(getattr(model, f.name) for f in fields(model)))
    found = rows.mapInArrow(_label(shared, ["doc_id", "letters"], switch), schema)
    return found.select(
        "doc_id",
        F.when(F.col("letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
        F.when(F.col("letters"), F.col("spans")).otherwise(none).alias("spans"),
    )
