"""Problem 8: texts into containers of fixed capacity by linear grouping.

Only counts per length decide the plan, and lengths are bounded by the capacity, so the plan is made on the
driver from a histogram of at most `capacity` numbers whatever the number of texts. Large lengths are
rounded up to the largest of their group of equal cardinality; container patterns over the few rounded
lengths are optimised by dynamic programming; actual texts take the rounded places, and small texts fill
the rest best-fit. Texts find their container from their rank among the texts of the same length.
"""

from __future__ import annotations

import base64
import os
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.session import Scratch

CAPACITY = 2048
#: Groups of the linear grouping; lengths from capacity / SMALL on are large.
GROUPS, SMALL = 64, 8


@lru_cache(2)
def _encoding(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Plan:
    """For each length a list of (first rank, containers from, texts per container), sorted by rank."""

    def __init__(self, capacity: int):
        self.capacity, self.used = capacity, 0
        self.rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)

    def place(self, size: int, rank: int, container: int, per: int) -> None:
        self.rows[size].append((rank, container, per))

    def new(self, n: int) -> int:
        self.used += n
        return self.used - n

    def frozen(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return {s: tuple(np.array(x, np.int64) for x in zip(*sorted(r))) for s, r in self.rows.items()}


def _best_pattern(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How many of each rounded length fill one container best, none more often than it is left.

    Dynamic program over the capacity: of equal fillings the one with larger lengths stands.
    """
    full = np.full(capacity + 1, -1, np.int64)  # group that reached this filling last
    full[0] = len(sizes)
    back = np.zeros(capacity + 1, np.int64)
    for g, s in enumerate(sizes):
        count = np.full(capacity + 1, 0)
        open_ = full >= 0
        for k in range(1, min(left[g], capacity // s) + 1):
            reach = np.zeros(capacity + 1, bool)
            reach[s:] = open_[:-s] if k == 1 else (count[:-s] == k - 1)
            fresh = reach & (full < 0)
            if not fresh.any():
                break
            full[fresh], back[fresh], count[fresh] = g, np.flatnonzero(fresh) - s, k
    at, out = int(np.flatnonzero(full >= 0)[-1]), [0] * len(sizes)
    while at:
        out[full[at]] += 1
        at = int(back[at])
    return out


def make_plan(hist: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """hist: number of items of each length from 1 to capacity."""
    plan = Plan(capacity)
    if n := hist.get(capacity, 0):
        plan.place(capacity, 0, plan.new(n), 1)
    large = sorted((s for s in hist if capacity / SMALL <= s < capacity), reverse=True)
    total = sum(hist[s] for s in large)
    each = max(1, -(-total // GROUPS))
    runs: list[tuple[int, int, int]] = []  # position in descending order, length, rank within the length
    at = 0
    for s in large:
        runs.append((at, s, 0))
        at += hist[s]
    starts = [r[0] for r in runs]

    def pieces(lo: int, hi: int) -> Iterator[tuple[int, int, int, int]]:
        """The items at places lo to hi: (place, length, rank of the first, number)."""
        k = int(np.searchsorted(starts, lo, "right")) - 1
        while lo < hi:
            n = min(hi, starts[k + 1] if k + 1 < len(starts) else total) - lo
            yield lo, runs[k][1], lo - starts[k], n
            lo, k = lo + n, k + 1

    groups = [(lo, min(lo + each, total)) for lo in range(0, total, each)]
    sizes = [next(pieces(lo, hi))[1] for lo, hi in groups]
    left = [hi - lo for lo, hi in groups]
    rests: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> runs of containers (first, number)
    while any(left):
        pattern = _best_pattern(sizes, left, capacity)
        times = min(l // k for l, k in zip(left, pattern) if k)
        first = plan.new(times)
        edges, placed = {0, times}, []
        for g, k in enumerate(pattern):
            if not k:
                continue
            lo = groups[g][1] - left[g]
            for j in range(k):  # the j-th share of this group's next items, one per container
                for place, s, rank, n in pieces(lo + j * times, lo + (j + 1) * times):
                    off = place - lo - j * times
                    plan.place(s, rank, first + off, 1)
                    placed.append((off, off + n, s))
                    edges |= {off, off + n}
            left[g] -= k * times
        cuts = sorted(edges)
        fill = np.zeros(len(cuts), np.int64)
        for a, b, s in placed:
            fill[np.searchsorted(cuts, a) : np.searchsorted(cuts, b)] += s
        for a, b, f in zip(cuts, cuts[1:], fill):
            if f < capacity:
                rests[capacity - int(f)].append((first + a, b - a))
    _fill(plan, rests, {s: n for s, n in hist.items() if s < capacity / SMALL})
    return plan


def _fill(plan: Plan, rests: dict[int, list[tuple[int, int]]], small: dict[int, int]) -> None:
    """Small items, longest first, each into the fullest container with room; runs of containers move together."""
    rooms = sorted(r for r in rests if rests[r])
    for s in sorted(small, reverse=True):
        n, rank = small[s], 0
        while rank < n:
            k = int(np.searchsorted(rooms, s))
            if k == len(rooms):
                per = plan.capacity // s
                count = -(-(n - rank) // per)
                first = plan.new(count)
                plan.place(s, rank, first, per)
                tail = n - rank - (count - 1) * per
                for room, run in ((plan.capacity - per * s, (first, count - 1)), (plan.capacity - tail * s, (first + count - 1, 1))):
                    _give(rests, rooms, room, run)
                break
            room = rooms[k]
            first, count = rests[room].pop()
            if not rests[room]:
                rooms.pop(k)
            use = min(count, n - rank)
            plan.place(s, rank, first, 1)
            rank += use
            _give(rests, rooms, room - s, (first, use))
            _give(rests, rooms, room, (first + use, count - use))


def _give(rests: dict[int, list[tuple[int, int]]], rooms: list[int], room: int, run: tuple[int, int]) -> None:
    if room and run[1]:
        if not rests[room]:
            insort(rooms, room)
        rests[room].append(run)


def pack(docs: DataFrame, scratch: Scratch, tokenizer: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, first_token, tokens, container), one row per text, or per piece of a text over capacity.

    A text over capacity fills containers of its own; its rest is an item like others. Null and empty texts
    take no room and get container null with 0 tokens. Repeated rows are packed each for itself.
    """
    path = tokenizer or default_tokenizer()
    docs.sparkSession.sparkContext.addFile(path)
    kind = dict(docs.dtypes)[doc_id]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles, TaskContext

        encoding, part, seen = _encoding(SparkFiles.get(os.path.basename(path))), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            n = np.array([len(encoding.encode_ordinary(t)) if t else 0 for t in b.column("text").to_pylist()], np.int64)
            pieces = np.maximum(1, -(-n // capacity))
            row = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            size = np.minimum(capacity, n[row] - piece * capacity)
            order = np.argsort(size, kind="stable")
            s = size[order]
            start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.empty(0, np.int64)
            ordinal = np.empty(len(s), np.int64)
            ordinal[order] = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)])) + seen[s]
            seen += np.bincount(size, minlength=capacity + 1)
            yield pa.RecordBatch.from_pydict({doc_id: b.column("d").take(pa.array(row)), "piece": pa.array(piece.astype(np.int32)), "tokens": pa.array(size.astype(np.int32)), "part": pa.array(np.full(len(row), part, np.int32)), "ordinal": pa.array(ordinal)})

    items = docs.select(F.col(doc_id).alias("d"), "text").mapInArrow(measure, f"{doc_id} {kind}, piece int, tokens int, part int, ordinal bigint")
    items = scratch.cut(items, "items")
    counts = scratch.cut(items.filter("tokens > 0").groupBy("part", "tokens").agg(F.count(F.lit(1)).alias("n")), "counts")
    hist = {r["tokens"]: r["n"] for r in counts.groupBy("tokens").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("tokens").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", "tokens", F.coalesce(before, F.lit(0)).alias("before"))
    plan = docs.sparkSession.sparkContext.broadcast(make_plan(hist, capacity).frozen())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = plan.value
        for b in batches:
            size, rank = b.column("tokens").to_numpy(), b.column("rank").to_numpy(zero_copy_only=False)
            out = np.full(len(size), -1, np.int64)
            for s in np.unique(size[size > 0]):
                at = np.flatnonzero(size == s)
                ranks, first, per = rows[int(s)]
                k = np.searchsorted(ranks, rank[at], "right") - 1
                out[at] = first[k] + (rank[at] - ranks[k]) // per[k]
            yield pa.RecordBatch.from_pydict({doc_id: b.column(doc_id), "piece": b.column("piece"), "first_token": pa.array(b.column("piece").to_numpy().astype(np.int64) * capacity), "tokens": b.column("tokens"), "container": pa.array(out, mask=out < 0)})

    ranked = items.join(offsets, ["part", "tokens"], "left").select(doc_id, "piece", "tokens", (F.col("ordinal") + F.coalesce("before", F.lit(0))).alias("rank"))
    return ranked.mapInArrow(assign, f"{doc_id} {kind}, piece int, first_token bigint, tokens int, container bigint")
