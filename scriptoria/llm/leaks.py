"""Problem 9: passages of held-out items inside a corpus, by the q-gram lemma.

Texts become their words, lower-cased, with one blank around each. A stretch of `RUN` words of an item with
L characters that occurs with at most `edits` edits shares at least L + 1 - q * (edits + 1) q-grams with
the document, on diagonals at most `edits` apart; q is Q, or less for items for which that bound would be
below 1. Shared q-grams are counted per document, item and overlapping band of diagonals; bands that reach
the item's least bound are verified by an alignment from each exact run to both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.arrow import WORD, mix

#: Characters of a q-gram at most; words of the shortest passage that counts.
Q, RUN = 16, 12
#: Characters of items that one broadcast index holds at most (one longer item makes its own index).
BLOCK_CHARS = 4_000_000
#: Characters of documents looked at together; one longer document is looked at alone.
CHUNK_CHARS = 500_000
#: Bits of the prefilter over q-gram hashes.
FILTER_BITS = 24


def _norm(text: str | None) -> str:
    return " " + " ".join(WORD.findall(text.lower())) + " " if text else " "


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q-gram at each position; q is a power of two."""
    h, step = codes.astype(np.uint64), 1
    while step < q:
        if len(h) <= step:
            return np.empty(0, np.uint64)
        h = h[:-step] * np.uint64(pow(0x9E3779B97F4A7C15, step, 1 << 64)) + h[step:]
        step *= 2
    return mix(h)


@dataclass
class ItemIndex:
    """Q-grams of a block of items: sorted hashes with their places in the joined text."""

    ids: list[int]
    codes: np.ndarray
    begin: np.ndarray
    least: np.ndarray  # fewest shared q-grams of a passage, by item
    hashes: np.ndarray
    places: np.ndarray
    filter: np.ndarray
    q: int


def build_indexes(items: list[tuple[int, str]], edits: int) -> list[ItemIndex]:
    """An index for every q that items need; none where no item has RUN words."""
    by_q: dict[int, list[tuple[int, str, int]]] = {}
    for item_id, text in items:
        t = _norm(text)
        ends = [i for i, c in enumerate(t) if c == " "]
        if item_id is None or len(ends) <= RUN:
            continue
        shortest = min(ends[k + RUN] - ends[k] + 1 for k in range(len(ends) - RUN))
        q = Q
        while q > 1 and shortest < q * (edits + 1):
            q //= 2
        by_q.setdefault(q, []).append((item_id, t, max(1, shortest + 1 - q * (edits + 1))))
    return [_index(*zip(*rows), q) for q, rows in sorted(by_q.items())]


def _index(ids: tuple[int, ...], texts: tuple[str, ...], least: tuple[int, ...], q: int) -> ItemIndex:
    codes = _codes("".join(texts))
    begin = np.cumsum([0, *map(len, texts)])
    h = _grams(codes, q)
    at = np.arange(len(h))
    inside = at + q <= begin[np.searchsorted(begin, at, "right")]
    h, at = h[inside], at[inside]
    order = np.argsort(h, kind="stable")
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return ItemIndex(list(ids), codes, begin, np.array(least), h[order], at[order], bits, q)


def _reach(a: np.ndarray, b: np.ndarray, edits: int) -> list[int]:
    """Most places of a that align to the begin of b with at most 0, 1 .. `edits` edits (furthest-reaching diagonals)."""
    best, out = {0: 0}, []
    for e in range(edits + 1):
        for d, x in best.items():
            y = x + d
            n = min(len(a) - x, len(b) - y)
            if n > 0:
                diff = np.flatnonzero(a[x : x + n] != b[y : y + n])
                best[d] = x + (int(diff[0]) if len(diff) else n)
        out.append(max(best.values()))
        if e < edits:
            step: dict[int, int] = {}
            for d, x in best.items():
                for to, place in ((d, x + 1), (d - 1, x + 1), (d + 1, x)):
                    if place <= len(a) and 0 <= place + to <= len(b):
                        step[to] = max(step.get(to, -1), place)
            for d, x in step.items():
                best[d] = max(best.get(d, -1), x)
    return out


def _words(a: np.ndarray, b: np.ndarray, x: int, y: int, edits: int) -> int:
    """Most whole words of a in a stretch around a[x:] and b[y:], the edits shared between both sides."""
    ahead, back = _reach(a[x:], b[y:], edits), _reach(a[:x][::-1], b[:y][::-1], edits)
    return max(int((a[x - back[e] : x + ahead[edits - e]] == 32).sum()) for e in range(edits + 1)) - 1


def find_leaks(text: np.ndarray, doc: np.ndarray, starts: np.ndarray, index: ItemIndex, edits: int) -> list[tuple[int, int, int]]:
    """(document number, item number, words) of every verified passage; words counts whole words of the item.

    text: joined codes of documents, doc: number of the document at each place, starts: their begins.
    """
    h = _grams(text, index.q)
    if not len(h):
        return []
    p = np.flatnonzero(index.filter[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    p = p[doc[p] == doc[p + index.q - 1]]
    lo, hi = np.searchsorted(index.hashes, h[p], "left"), np.searchsorted(index.hashes, h[p], "right")
    n = hi - lo
    at = np.repeat(p, n)
    place = index.places[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    if not len(at):
        return []
    item, number = np.searchsorted(index.begin, place, "right") - 1, doc[at]
    diagonal = (at - starts[number]) - (place - index.begin[item]) + (1 << 40)
    width = 4 * edits + 2
    found: dict[tuple[int, int], int] = {}
    for shift in (0, width // 2):
        band = (diagonal + shift) // width
        order = np.lexsort((place, band, item, number))
        key = np.stack([number[order], item[order], band[order]])
        new = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)])
        size = np.diff(np.r_[new, len(order)])
        for k in np.flatnonzero(size >= index.least[key[1][new]]):
            rows = order[new[k] : new[k] + size[k]]
            d, i = int(number[rows[0]]), int(item[rows[0]])
            a = index.codes[index.begin[i] : index.begin[i + 1]]
            b = text[starts[d] : starts[d + 1]]
            x, y = place[rows] - index.begin[i], at[rows] - starts[d]
            first = np.flatnonzero(np.r_[True, (np.diff(x) != 1) | (np.diff(y) != 1)])
            for f in first:
                found[d, i] = max(found.get((d, i), 0), _words(a, b, int(x[f]), int(y[f]), edits))
    return [(d, i, w) for (d, i), w in found.items() if w >= RUN]


def leaked_items(docs: DataFrame, items: DataFrame, edits: int = 0, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, words): documents with at least RUN consecutive words of an item within `edits` edits.

    With edits = 0 the words agree exactly. words is the most words of the item found in one place. Null or
    short texts and null ids leak nothing. The items are a stated query set: they are indexed in blocks of
    bounded size. Documents are read once; a task meets its documents with one block after the other and
    holds one at a time.
    """
    spark = docs.sparkSession
    sized = items.select(F.col(item_id).cast("long").alias("i"), F.col("text").alias("t")).filter("i is not null and t is not null").distinct()
    total = sized.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    blocks = int(total // BLOCK_CHARS) + 1
    schema = f"{doc_id} bigint, {item_id} bigint, words int"
    shared = []
    for k in range(blocks):
        part = sized.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k).toArrow()
        indexes = build_indexes(sorted(zip(part["i"].to_pylist(), part["t"].to_pylist())), edits)
        if indexes:
            shared.append(spark.sparkContext.broadcast(indexes))
    if not shared:
        return spark.createDataFrame([], schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("d").to_pylist()
            texts = [_norm(t) for t in b.column("text").to_pylist()]
            size = np.array([len(t) for t in texts], np.int64)
            total = np.cumsum(size)
            for block in shared:
                indexes, rows, lo = block.value, [], 0
                while lo < len(texts):
                    hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + CHUNK_CHARS, "right")))
                    starts = np.r_[0, np.cumsum(size[lo:hi])]
                    codes, doc = _codes("".join(texts[lo:hi])), np.repeat(np.arange(hi - lo, dtype=np.int32), size[lo:hi])
                    for index in indexes:
                        rows += [(lo + d, index.ids[i], w) for d, i, w in find_leaks(codes, doc, starts, index, edits)]
                    lo = hi
                if len(shared) > 1:
                    block.__dict__.pop("_value", None)  # read again from the executor's disk when the next batch needs it
                yield pa.RecordBatch.from_pydict({
                    doc_id: pa.array([ids[d] for d, _, _ in rows], pa.int64()), item_id: pa.array([i for _, i, _ in rows], pa.int64()), "words": pa.array([w for _, _, w in rows], pa.int32()),
                })

    found = docs.select(F.col(doc_id).cast("long").alias("d"), "text").filter("d is not null and text is not null").mapInArrow(scan, schema)
    return found.groupBy(doc_id, item_id).agg(F.max("words").alias("words"))
