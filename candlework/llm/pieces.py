"""N best segmentations of whole texts over the pieces of a SentencePiece vocabulary.

A path through the lattice of pieces costs the sum of its pieces. The forward Viterbi
costs of a lattice are exact for what is left of a backward search, so that A* finds the
N best paths in order without a detour.

As no piece has a space behind another character or a line end beside one, a text falls
into segments (a word with the spaces before it, a line end) which every path respects.
Distinct segments are solved at once, as arrays; the N best of a text are put together
from those of the few segments whose second best path costs least.

The vocabulary gives merge ranks, not probabilities. The cost of a piece is that of
Zipf's law: the logarithm of its rank, in whole millionths, so that sums are exact.
"""

from __future__ import annotations

import bisect
import heapq
import math
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from candlework.llm.text import _BASE, _BYTE, blocks, inverse_powers, mix, powers, span_hashes, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
#: Cost of a byte of a character that has no piece.
BYTE_COST = 20_000_000
#: Longer segments are solved one by one.
ARRAY_BYTES = 48
BLOCK = 1 << 20
#: Ids decoded at a time; a longer single text is decoded alone.
DECODED = 1 << 18
#: Segments whose N best are kept for later texts of a task: some 30 MB.
KNOWN = 1 << 14
FAR = np.int64(1) << 60
_SLOT_BITS = 20


@dataclass
class Vocabulary:
    """Pieces as bytes, with a space for the mark of one. ``ids``: piece to id."""

    pieces: list[bytes]
    ids: dict[bytes, int]
    costs: np.ndarray
    longest: int
    hashes: np.ndarray = field(repr=False)
    slots: np.ndarray = field(repr=False)
    crowded: np.ndarray = field(repr=False)
    crowded_ids: np.ndarray = field(repr=False)
    first_byte: int = 3


def vocabulary(pieces: list[bytes], first_byte: int = 3) -> Vocabulary:
    """``pieces`` by id; the 256 from ``first_byte`` stand for bytes, those before for nothing."""
    start = first_byte + 256
    ids = {p: i for i, p in enumerate(pieces) if i >= start and p}
    costs = np.zeros(len(pieces), np.int64)
    for i in range(start, len(pieces)):
        costs[i] = round(1e6 * math.log(i - start + 2))
    costs[first_byte:start] = BYTE_COST
    keys = list(ids)
    ends = np.cumsum([len(p) for p in keys]) if keys else np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(keys), np.uint8)
    hashes = span_hashes(data, ends - [len(p) for p in keys], ends) if keys else np.zeros(0, np.uint64)
    by_id = np.zeros(len(pieces), np.uint64)
    by_id[list(ids.values())] = hashes
    place = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
    slots = np.full(1 << _SLOT_BITS, -1, np.int32)
    slots[place] = list(ids.values())
    shared = np.flatnonzero(np.bincount(place, minlength=1 << _SLOT_BITS) > 1)
    slots[shared] = -2
    of = np.isin(place, shared)
    order = np.argsort(hashes[of])
    return Vocabulary(
        pieces, ids, costs, max(map(len, keys), default=1), by_id, slots,
        hashes[of][order], np.array(list(ids.values()), np.int64)[of][order], first_byte,
    )


def _plain(v: Vocabulary) -> tuple:
    """Without the class, which a broadcast names only: workers need no copy of the package."""
    return tuple(getattr(v, f.name) for f in fields(v))


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """The pieces of a SentencePiece model file, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    first = next(i for i in range(n) if model.is_byte(i))
    pieces = [
        b"" if model.is_control(i) or model.is_unknown(i)
        else bytes([i - first]) if model.is_byte(i)
        else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(n)
    ]
    return vocabulary(pieces, first)


def _lookup(v: Vocabulary, h: np.ndarray) -> np.ndarray:
    """The id of each hashed span, -1 where it is no piece."""
    found = v.slots[(h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)].astype(np.int64)
    crowd = np.flatnonzero(found == -2)
    if len(crowd):
        at = np.minimum(np.searchsorted(v.crowded, h[crowd]), len(v.crowded) - 1)
        found[crowd] = np.where(v.crowded[at] == h[crowd], v.crowded_ids[at], -1)
    own = found >= 0
    found[own & (v.hashes[np.maximum(found, 0)] != h)] = -1
    return found


# One segment at a time


def _character(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def _lone(v: Vocabulary, segment: bytes) -> bytearray:
    """For each byte whether it is of a character without a piece."""
    out = bytearray(len(segment))
    for p in range(len(segment)):
        if segment[p] & 0xC0 != 0x80:
            size = min(_character(segment[p]), len(segment) - p)
            if segment[p : p + size] not in v.ids:
                out[p : p + size] = bytes([1]) * size
    return out


def _edges(v: Vocabulary, segment: bytes, lone: bytearray, end: int) -> list[tuple[int, int, int]]:
    """The edges (length, id, cost) that lead to ``end``."""
    found = [(1, v.first_byte + segment[end - 1], BYTE_COST)] if lone[end - 1] else []
    for p in range(end - 1, max(end - v.longest, 0) - 1, -1):
        if segment[p] & 0xC0 != 0x80:
            i = v.ids.get(segment[p:end])
            if i is not None:
                found.append((end - p, i, int(v.costs[i])))
    return found


def lattice(v: Vocabulary, segment: bytes) -> list[list[tuple[int, int, int]]]:
    """For each end the edges that lead to it."""
    lone = _lone(v, segment)
    return [[], *[_edges(v, segment, lone, end) for end in range(1, len(segment) + 1)]]


class _Step:
    """A path from the end of a segment back to ``place``; steps share what lies behind them.

    ``jump`` is a step further behind, such that any step is reached in few jumps.
    """

    __slots__ = ("total", "place", "cost", "id", "length", "above", "jump", "depth")

    def __init__(self, total, place, cost, id=0, length=0, above=None):
        self.total, self.place, self.cost, self.id, self.length, self.above = total, place, cost, id, length, above
        if above is None:
            self.depth, self.jump = 0, self
        else:
            self.depth = above.depth + 1
            far = above.jump
            self.jump = far.jump if above.depth - far.depth == far.depth - far.jump.depth else above

    def __lt__(self, other):
        """By cost of the best path through it; among equals the longer pieces first, from the end."""
        if self.total != other.total:
            return self.total < other.total
        a, b = self, other
        while a.depth != b.depth:
            if a.depth > b.depth:
                a = a.jump if a.jump.depth >= b.depth else a.above
            else:
                b = b.jump if b.jump.depth >= a.depth else b.above
        if a is b:
            return self.depth < other.depth
        while a.above is not b.above:
            a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.above, b.above)
        return a.length > b.length

    def ids(self) -> list[int]:
        out, step = [], self
        while step.above is not None:
            out.append(step.id)
            step = step.above
        return out


def n_best(v: Vocabulary, segment: bytes, n: int) -> list[tuple[int, list[int]]]:
    """The n cheapest paths (cost, ids) in order; of equal ones that with the longer last pieces first.

    A step is left out once n others, with no path in common, are known to lead to cheaper
    paths; so the memory is that of n paths, however long the segment.
    """
    lone = _lone(v, segment)
    ahead = np.full(len(segment) + 1, FAR)
    ahead[0] = 0
    for end in range(1, len(segment) + 1):
        ahead[end] = min((int(ahead[end - k]) + c for k, _, c in _edges(v, segment, lone, end)), default=int(FAR))
    out: list[tuple[int, list[int]]] = []
    heap = [_Step(int(ahead[-1]), len(segment), 0)]
    # The totals of the n best of all steps that are not continued by another one.
    least = [int(ahead[-1])]
    while heap and len(out) < n:
        step = heapq.heappop(heap)
        if step.place == 0:
            out.append((step.total, step.ids()))
            continue
        onward = [
            _Step(step.cost + c + int(ahead[step.place - k]), step.place - k, step.cost + c, i, k, step)
            for k, i, c in _edges(v, segment, lone, step.place)
        ]
        onward.sort()
        # The first goes on with the step's own total, the others are new.
        for other in onward[1:]:
            if len(least) < n or other.total < least[-1]:
                bisect.insort(least, other.total)
                del least[n:]
        for other in onward:
            if len(least) < n or other.total <= least[-1]:
                heapq.heappush(heap, other)
    return out


# Many segments at once


def _solve(v: Vocabulary, rows: np.ndarray, sizes: np.ndarray):
    """Best ids, their number, cost and the extra cost of the second best path of each row.

    ``rows``: the segments' bytes, padded to one width, the longest first.
    """
    u, w = rows.shape
    rows = np.ascontiguousarray(rows.T)
    sums = np.zeros((w + 1, u), np.uint64)
    np.cumsum(_BYTE[rows] * powers(_BASE, w)[:, None], axis=0, out=sums[1:])
    inverse = inverse_powers(w + 1)
    # At place e only the first reach[e] rows go on.
    reach = [int(np.searchsorted(-sizes, -e, side="right")) for e in range(w + 1)]
    lone = np.ones((w, u), bool)  # bytes of characters without a piece
    size = np.select([rows < 0x80, rows < 0xE0, rows < 0xF0], [1, 2, 3], 4)
    edge: dict[tuple[int, int], np.ndarray] = {}
    costs = np.append(v.costs, FAR)  # -1: no edge
    for e in range(1, w + 1):
        m = reach[e]
        for k in range(1, min(e, v.longest) + 1):
            a = e - k
            found = _lookup(v, mix((sums[e, :m] - sums[a, :m]) * inverse[a] + np.uint64(k)))
            if k <= 4:
                known = (found >= 0) & (size[a, :m] == k)
                lone[a:e, :m] &= ~known
            if (found >= 0).any():
                edge[e, k] = found.astype(np.int32)
    ahead = np.full((w + 1, u), FAR)
    ahead[0] = 0
    length = np.ones((w + 1, u), np.int8)
    best_id = np.full((w + 1, u), -1, np.int32)
    best_id[1:] = v.first_byte + rows.astype(np.int32)
    byte_cost = np.where(lone, np.int64(BYTE_COST), FAR)
    for e in range(1, w + 1):
        m = reach[e]
        here = ahead[e, :m]
        np.add(ahead[e - 1, :m], byte_cost[e - 1, :m], out=here)
        for k in range(1, min(e, v.longest) + 1):
            if (e, k) in edge:
                cost = ahead[e - k, :m] + costs[edge[e, k]]
                better = cost <= here
                np.copyto(here, cost, where=better)
                np.copyto(length[e, :m], np.int8(k), where=better)
                np.copyto(best_id[e, :m], edge[e, k], where=better)
        np.minimum(here, FAR, out=here)
    every = np.arange(u)
    behind = np.full((w + 1, u), FAR)
    behind[sizes, every] = 0
    second = np.full(u, FAR)
    on = np.zeros((w + 1, u), bool)
    on[sizes, every] = True
    for e in range(w, 0, -1):
        m = reach[e]
        here = np.flatnonzero(on[e, :m])
        on[e - length[e, here].astype(np.int64), here] = True
        chosen = np.where(on[e, :m], np.where(best_id[e, :m] < v.first_byte + 256, 0, length[e, :m]), -1)
        for k in range(0, min(e, v.longest) + 1):
            if k and (e, k) not in edge:
                continue
            # All edges from e on are known, so this is final: the best path through the edge.
            onward = behind[e, :m] + (costs[edge[e, k]] if k else byte_cost[e - 1, :m])
            a = e - max(k, 1)
            np.minimum(behind[a, :m], onward, out=behind[a, :m])
            onward += ahead[a, :m]
            np.minimum(second[:m], onward, out=second[:m], where=chosen != k)
    on[0] = False
    total = ahead[sizes, every]
    return best_id.T[on.T], on.sum(axis=0), total, np.where(second >= FAR, FAR, second - total)


_WIDTHS = (8, 16, 32, ARRAY_BYTES)


def solve(v: Vocabulary, segments: list[bytes]):
    """(ids one after the other, where each segment's begin, costs, extra costs of the second best)."""
    sizes = np.array([len(s) for s in segments], np.int64)
    counts = np.zeros(len(segments), np.int64)
    costs, extra = np.zeros(len(segments), np.int64), np.full(len(segments), FAR)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    low = 0
    for width in _WIDTHS:
        group = np.flatnonzero((sizes > low) & (sizes <= width))
        group = group[np.argsort(-sizes[group], kind="stable")]
        low = width
        step = max(256, (1 << 21) // (width * width))
        for i in range(0, len(group), step):
            some = group[i : i + step]
            joined = np.frombuffer(b"".join(segments[j].ljust(width, b"\0") for j in some.tolist()), np.uint8)
            ids, n, costs[some], extra[some] = _solve(v, joined.reshape(len(some), width), sizes[some])
            counts[some] = n
            parts.append((some, ids))
    for j in np.flatnonzero(sizes > ARRAY_BYTES).tolist():
        found = n_best(v, segments[j], 2)
        ids = np.array(found[0][1], np.int64)
        counts[j], costs[j] = len(ids), found[0][0]
        if len(found) > 1:
            extra[j] = found[1][0] - found[0][0]
        parts.append((np.array([j]), ids))
    first = np.zeros(len(segments) + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    out = np.zeros(first[-1], np.int32)
    for some, ids in parts:
        out[_ragged(first[some], counts[some])] = ids
    return out, first, costs, extra


def _ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0] ... start[0] + count[0] - 1, start[1] ..."""
    total = int(count.sum())
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(total)


def segment_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(data)
    space, line = data == 0x20, data == 0x0A
    starts = line.copy()
    starts[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    begins = offsets[:-1]
    starts[begins[begins < n]] = True
    return np.flatnonzero(starts)


def _texts(v: Vocabulary, column: pa.Array, n: int, known: dict[bytes, list[tuple[int, list[int]]]]):
    """Of each text: ids (one array and offsets), the costs of its N best, and their changes."""
    data, offsets = text_bytes(column)
    start = segment_starts(data, offsets)
    end = np.append(start[1:], len(data))
    first = np.searchsorted(start, offsets)
    h = span_hashes(data, start, end)
    _, at, which = np.unique(h, return_index=True, return_inverse=True)
    segments = [data[a:b].tobytes() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
    ids, id_first, costs, extra = solve(v, segments)
    count = np.diff(id_first)
    flat = ids[_ragged(id_first[which], count[which])]
    ends = np.zeros(len(which) + 1, np.int64)
    np.cumsum(count[which], out=ends[1:])
    sums = np.zeros(len(which) + 1, np.int64)
    np.cumsum(costs[which], out=sums[1:])
    best = sums[first[1:]] - sums[first[:-1]]
    all_costs, all_changes = [], []
    for d in range(len(column)):
        a, b = int(first[d]), int(first[d + 1])
        paths = [(0, ())]
        for j in _cheapest(extra[which[a:b]], n - 1):
            s = segments[which[a + j]]
            if s not in known:
                known[s] = n_best(v, s, n)
            least = known[s][0][0]
            paths = sorted(
                (c + k - least, (*changes, (j, r)) if r else changes)
                for c, changes in paths
                for r, (k, _) in enumerate(known[s])
            )[:n]
        all_costs.append([int(best[d]) + c for c, _ in paths])
        all_changes.append(
            [[{"segment": j, "ids": known[segments[which[a + j]]][r][1]} for j, r in changes] for _, changes in paths[1:]]
        )
    return flat, ends[first], all_costs, all_changes


def _cheapest(extra: np.ndarray, n: int) -> list[int]:
    """The n places of least extra cost, earlier ones first among equals; none without a second path."""
    if n < 1:
        return []
    if len(extra) > n:
        bound = np.partition(extra, n - 1)[n - 1]
        less = np.flatnonzero(extra < bound)
        places = np.concatenate([less, np.flatnonzero(extra == bound)[: n - len(less)]])
    else:
        places = np.arange(len(extra))
    return sorted(places[extra[places] < FAR].tolist())


_CHANGES = pa.list_(pa.list_(pa.struct([("segment", pa.int32()), ("ids", pa.list_(pa.int32()))])))


def _lists(flat: np.ndarray, ends: np.ndarray, null: np.ndarray) -> pa.Array:
    offsets = pa.array(ends.astype(np.int32), mask=np.append(null, False))
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))


def _encode(vocabulary, n: int, column: str, keep: list[str]):
    def run(batches):
        v, known = Vocabulary(*vocabulary.value), {}
        for batch in batches:
            texts = batch.column(column)
            for a, b in blocks(texts, BLOCK):
                if len(known) > KNOWN:
                    known.clear()
                part = batch.slice(a, b - a)
                flat, ends, costs, changes = _texts(v, part.column(column), n, known)
                null = part.column(column).is_null().to_numpy(zero_copy_only=False)
                for d in np.flatnonzero(null).tolist():
                    costs[d] = changes[d] = None
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep]
                    + [_lists(flat, ends, null), pa.array(costs, pa.list_(pa.int64())), pa.array(changes, _CHANGES)],
                    names=[*keep, "ids", "costs", "changes"],
                )

    return run


def encode(docs: DataFrame, v: Vocabulary | None = None, n: int = N_BEST, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` (nor columns of the new names), with ``ids``, ``costs`` and ``changes``.

    ``ids`` is the cheapest segmentation of the whole text, of equal ones that with the
    longer last pieces. ``costs`` are those of the up to n cheapest, in order. ``changes``
    says, for each after the first, which segments are cut differently, and how: of
    equally cheap ones with changes in earlier segments first. Nothing is added before
    the text, no character is folded, and characters without a piece become bytes, so
    ``decode`` gives the text again. A null text gives nulls, an empty one no ids.
    """
    spark = docs.sparkSession
    v = load_vocabulary() if v is None else v
    keep = [f for f in docs.schema if f.name not in (text, "ids", "costs", "changes")]
    new = T._parse_datatype_string(
        "ids array<int>, costs array<bigint>, changes array<array<struct<segment: int, ids: array<int>>>>"
    )
    names = [f.name for f in keep]
    return docs.select(*names, text).mapInArrow(
        _encode(spark.sparkContext.broadcast(_plain(v)), n, text, names), T.StructType([*keep, *new.fields])
    )


def _decoded(data, start, size, lists: pa.Array) -> list[str | None]:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(size[flat], out=ends[1:])
    joined = data[_ragged(start[flat], size[flat])].tobytes()
    cuts = ends[np.append(0, np.cumsum(counts))].tolist()
    null = lists.is_null().to_pylist()
    return [None if no else joined[a:b].decode() for a, b, no in zip(cuts[:-1], cuts[1:], null, strict=True)]


def _decode(table, column: str, keep: list[str]):
    def run(batches):
        data, start = table.value
        size = np.diff(start)
        for batch in batches:
            lists = batch.column(column)
            counts = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            texts, a = [], 0
            while a < len(batch):
                before = int(counts[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(counts, before + DECODED, side="right")))
                texts += _decoded(data, start, size, lists.slice(a, b - a))
                a = b
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(texts, pa.string())], names=[*keep, "text"]
            )

    return run


def decode(encoded: DataFrame, v: Vocabulary | None = None, ids: str = "ids") -> DataFrame:
    """``encoded`` without ``ids`` (nor a column ``text``), with the ``text`` they stand for; null stays null."""
    spark: SparkSession = encoded.sparkSession
    v = load_vocabulary() if v is None else v
    start = np.zeros(len(v.pieces) + 1, np.int64)
    np.cumsum([len(p) for p in v.pieces], out=start[1:])
    table = spark.sparkContext.broadcast((np.frombuffer(b"".join(v.pieces), np.uint8), start))
    keep = [f for f in encoded.schema if f.name not in (ids, "text")]
    names = [f.name for f in keep]
    return encoded.select(*names, ids).mapInArrow(
        _decode(table, ids, names), T.StructType([*keep, T.StructField("text", T.StringType())])
    )
