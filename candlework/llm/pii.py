"""Personal data: patterns propose spans, checksums confirm them, context scores them."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of the base, in the order in which they are listed; they are kept at any score.
BASE = ("email", "ip", "card", "phone")
#: Kinds that the method adds; they need a score of at least THRESHOLD.
ADDED = ("iban", "ssn", "secret")
KINDS = BASE + ADDED
THRESHOLD = 0.5
#: Context words are looked for in so many characters on either side.
REACH = 40

SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its first digit only: if that fails, so would the rest.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,})"
    r"(?![A-Za-z0-9])"
)

#: Score of a confirmed span without context, and what a word for or against it adds or
#: takes. A number of which one in 97 passes its check needs no word, one against it tells;
#: a number without a check needs a word for it; a secret says itself what it is.
_START = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.6, "ssn": 0.4, "secret": 0.9}
_STEP = 0.2
#: Words near a span that speak for it.
_FOR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "server", "address", "host"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "bank", "account"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("key", "token", "secret", "password"),
}
#: Words near a span that speak against any kind.
_AGAINST = ("version", "example", "isbn", "order", "sample")
_WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, digit sums added: a multiple of ten."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) << (i & 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    """Country and check digits moved to the end, letters as numbers: remainder 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str):
    # Each "@" has at most one match: the whole run of allowed characters before it.
    free = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            free = m.end()


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _proposed(text: str, digit: bool):
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    if digit:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                yield "ip", m.start(), m.end()
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                yield "card", m.start(), m.end()
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    yield "phone", m.start(), m.end()
        for m in _IBAN.finditer(text):
            if 15 <= len(d := m[0].replace(" ", "")) <= 34 and mod_97(d):
                yield "iban", m.start(), m.end()
        if "-" in text:
            for m in _SSN.finditer(text):
                if m[0][:3] not in ("000", "666") and m[0][0] != "9":
                    yield "ssn", m.start(), m.end()
    for m in _SECRET.finditer(text):
        yield "secret", m.start(), m.end()


def _score(kind: str, text: str, a: int, b: int) -> float:
    near = set(_WORD.findall((text[max(0, a - REACH) : a] + " " + text[b : b + REACH]).lower()))
    score = _START[kind]
    if any(w.startswith(f) for w in near for f in _FOR[kind]):
        score += _STEP
    if near.intersection(_AGAINST):
        score -= _STEP
    return round(min(1.0, max(0.0, score)), 2)


_ANY_DIGIT = re.compile("[0-9]")


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text: (kind, start, end, score) by kind, then start; end exclusive."""
    if not text:
        return []
    spans = []
    for kind, a, b in _proposed(text, _ANY_DIGIT.search(text) is not None):
        score = _score(kind, text, a, b)
        if kind in BASE or score >= THRESHOLD:
            spans.append((kind, a, b, score))
    spans.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    return spans


def redacted(text: str, spans) -> str:
    """The text with every span replaced by its kind; of overlapping spans as one."""
    out, free = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= free:
            out += [text[free:a], f"<{kind.upper()}>"]
        free = max(free, b)
    return "".join(out) + text[free:]


def _of_batches(column: str, redact: bool, least: float, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            texts = batch.column(column).to_pylist()
            found = [[s for s in find(t) if s[3] >= least] for t in texts]
            columns = list(batch.columns)
            at = batch.schema.get_field_index(column)
            if redact:
                columns[at] = pa.array(
                    [redacted(t, s) if s else t for t, s in zip(texts, found, strict=True)], pa.string()
                )
            else:
                rows = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in f] for f in found]
                columns[at] = pa.array(rows, schema.field(column).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _mapped(df: DataFrame, column: str, redact: bool, kind, least: float = 0.0) -> DataFrame:
    fields = [T.StructField(f.name, kind if f.name == column else f.dataType) for f in df.schema]
    arrow = pa.schema(
        [
            pa.field(column, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
            )))
        ]
    )
    return df.mapInArrow(_of_batches(column, redact, least, arrow), T.StructType(fields))


def pii_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``spans``: kind, start, end (code points, end exclusive) and score.

    Null and empty texts have no spans; repeated rows and null keys stay as they are,
    other columns are left out. Matches of one kind do not overlap; different kinds may.
    """
    return _mapped(docs.select(key, F.col(text).alias("spans")), "spans", False, SPAN)


def redact_pii(docs: DataFrame, text: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` with every span of ``text`` that scores ``least`` replaced by its kind in angle brackets.

    All other columns and rows stay; a null text stays null.
    """
    return _mapped(docs, text, True, T.StringType(), least)


def pii_digest(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of ``pii_spans``."""

    def joined(column):
        return F.array_join(
            F.transform(
                column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
            ),
            ",",
        )

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    scores = F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",")
    return spans.select(
        key, *map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        scores.alias("scores"),
    )


