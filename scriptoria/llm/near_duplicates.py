"""Problem 4: near-duplicate records by the generalised pigeonhole principle.

A text is the bit vector of its distinct runs of three words. Similarity of at least 1/2 between a text y
and a text x with no fewer bits means that x misses at most a third of y's bits: a Hamming bound on the
bits of y. The bits are grouped by their least word, so bits that change together lie in one group. Each
text gets its own threshold per group, possibly none, by dynamic programming over estimated candidate
counts, so that the thresholds' sum exceeds the bound; then some group keeps within its threshold. A group
with threshold T is probed through T + 1 of its bits, one of which x must have, and x counts as a candidate
if a mask of its own group shows at most T of y's bits missing. Candidates are verified on the words
themselves. No pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.functions.text import words
from scriptoria.llm.arrow import WordHash, mix, runs
from scriptoria.operators.skew import HARMLESS, hot_keys, salted_join
from scriptoria.session import Scratch

#: Words in a run.
RUN = 3
#: The histogram of bit counts has twice 2**HIST_BITS cells whatever the input; it is all that is broadcast.
HIST_BITS = 20
#: Cost of a row met while probing, against 1 for a candidate.
SCAN = 0.02
#: Cells of the dynamic program held at once; so many stay in a core's cache.
DP_CELLS = 100_000
#: Parts that the rows of a bit beyond HARMLESS are spread over.
SALTS = 32


def _bits(texts: list[str], cache: WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of each text: (text number, hash, group), in order of text, group and hash."""
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = t.split(" ")
        counts[i] = len(w)
        flat.extend([cache[x] for x in w])
    word = np.array(flat, np.uint64)
    h, text, at = runs(word, counts, RUN)
    group = np.minimum(np.minimum(word[at], word[at + 1]), word[at + 2])
    order = np.lexsort((h, group, text))
    h, text, group = h[order], text[order], group[order]
    if not len(h):
        return text, h, group
    first = np.r_[True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])]
    return text[first], h[first], group[first]


def _groups(text: np.ndarray, h: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first row, hash, 32-bit mask) of each group; the rows are in order of text and group."""
    at = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (text[1:] != text[:-1])])
    sig = mix(np.add.reduceat(mix(h), at))
    return at, sig, np.bitwise_or.reduceat(np.int64(1) << ((h >> np.uint64(9)) & np.uint64(31)).astype(np.int64), at)


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - HIST_BITS)).astype(np.int64)


def _thresholds(need: np.ndarray, part_text: np.ndarray, part_at: np.ndarray, part_n: np.ndarray, cost: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """How many bits to probe in each group: gains that sum to need[text] at the least estimated cost.

    Groups are in order of text; the bits of group k are cost[part_at[k]:][:part_n[k]], ascending. A gain
    of 1 asks for the whole group, which whole[k] texts have. For more, the candidates of a group's bits
    overlap, as the bits come from the same words: their number is put halfway between the largest single
    count and the sum. Every row met while probing costs SCAN of a candidate.
    """
    gain = np.zeros(len(part_text), np.int64)
    texts, begin, groups = np.unique(part_text, return_index=True, return_counts=True)
    order = np.lexsort((groups, need[texts]))
    lo = 0
    while lo < len(order):
        hi, k_max, p_max = lo, 0, 0
        while hi < len(order):
            k, p = max(k_max, need[texts[order[hi]]]), max(p_max, groups[order[hi]])
            if hi > lo and (hi - lo + 1) * p * (k + 1) > DP_CELLS:
                break
            k_max, p_max, hi = int(k), int(p), hi + 1
        rows = order[lo:hi]
        r = np.arange(len(rows))
        dp = np.full((len(rows), k_max + 1), np.inf)
        dp[:, 0] = 0
        taken = np.zeros((p_max, len(rows), k_max + 1), np.int32)
        for j in range(p_max):
            has = groups[rows] > j
            part = np.where(has, begin[rows] + j, 0)
            size, at = np.where(has, part_n[part], 0), part_at[part]
            new, total, most = dp.copy(), np.zeros(len(rows)), np.zeros(len(rows))
            for g in range(1, min(int(size.max(initial=0)), k_max) + 1):
                ok = size >= g
                c = np.where(ok, cost[np.where(ok, at + g - 1, 0)], np.inf)
                total, most = total + c, np.maximum(most, c)
                found = np.minimum(whole[part], c) if g == 1 else (total + most) / 2
                cand = dp[:, : k_max + 1 - g] + np.where(ok, found + SCAN * total, np.inf)[:, None]
                better = cand < new[:, g:]
                new[:, g:][better] = cand[better]
                taken[j][:, g:][better] = g
            dp = new
        left = need[texts[rows]].astype(np.int64)
        for j in range(p_max - 1, -1, -1):
            g = taken[j][r, left]
            use = g > 0
            gain[begin[rows[use]] + j] = g[use]
            left = left - g
        lo = hi
    return gain


def _histogram(reps: DataFrame) -> np.ndarray:
    """How many texts have a bit, and how many a whole group, of each cell, over all texts."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, sums = WordHash(), np.zeros((2, 1 << HIST_BITS), np.int64)
        for b in batches:
            text, h, group = _bits(b.column("norm").to_pylist(), cache)
            if len(h):
                sums[0] += np.bincount(_cell(h), minlength=1 << HIST_BITS)
                sums[1] += np.bincount(_cell(_groups(text, h, group)[1]), minlength=1 << HIST_BITS)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(at.astype(np.int32)), "n": pa.array(sums.ravel()[at].astype(np.int32))})

    got = reps.select("norm").mapInArrow(cells, "cell int, n int").groupBy("cell").agg(F.sum("n").cast("int").alias("n")).toArrow()
    hist = np.zeros(2 << HIST_BITS, np.float32)
    hist[got["cell"].to_numpy()] = got["n"].to_numpy()
    return hist.reshape(2, -1)


def _choose(texts: list[str], cache: WordHash, counts: np.ndarray):
    """Bits in order of text, group and count, with their group number, and by group first row, mask and gain."""
    text, h, group = _bits(texts, cache)
    est = counts[0][_cell(h)].astype(np.float64)
    order = np.lexsort((h, est, group, text))
    text, h, group, est = text[order], h[order], group[order], est[order]
    if not len(h):
        return text, h, est, text, text, text, text, text > 0
    at, sig, mask = _groups(text, h, group)
    sizes = np.diff(np.r_[at, len(h)])
    n = np.bincount(text, minlength=len(texts))
    gain = _thresholds(n // 3 + 1, text[at], at, sizes, est, counts[1][_cell(sig)].astype(np.float64))
    part = np.repeat(np.arange(len(at)), sizes)
    return text, h, est, n, mask, gain, part, np.arange(len(h)) - at[part] < gain[part]


def _probed_cells(reps: DataFrame, hist) -> np.ndarray:
    """For each cell whether any text probes a bit of it: 2**HIST_BITS truth values, from all texts."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = WordHash(), np.zeros(1 << HIST_BITS, bool)
        for b in batches:
            _, h, *_, probe = _choose(b.column("norm").to_pylist(), cache, hist.value)
            seen[_cell(h[probe])] = True
        at = np.flatnonzero(np.packbits(seen))
        yield pa.RecordBatch.from_pydict({"at": pa.array(at.astype(np.int32)), "bits": pa.array(np.packbits(seen)[at].astype(np.int32))})

    got = reps.select("norm").mapInArrow(cells, "at int, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed = np.zeros(1 << (HIST_BITS - 3), np.uint8)
    packed[got["at"].to_numpy()] = got["bits"].to_numpy()
    return np.unpackbits(packed).astype(bool)


def _probes(reps: DataFrame, hist, probed) -> DataFrame:
    """(h, salt, rid, n, m, s): the bits of every text that some text may probe.

    n: 64 * size of the text + 4 * gain of the bit's group, at most 15 there, + kind; kind 0: indexed, 1:
    indexed and probing, 2: probing copy. m: mask of the group and, above it, with s, a sketch of 96 cells
    of the whole text.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, counts, wanted = WordHash(), hist.value, probed.value
        for b in batches:
            text, h, est, n, mask, gain, part, probe = _choose(b.column("norm").to_pylist(), cache, counts)
            if not len(h):
                continue
            rid = b.column("rid").to_numpy()
            start = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            cell = ((h >> np.uint64(15)) % np.uint64(96)).astype(np.int64)
            one = np.uint64(1)
            low = np.bitwise_or.reduceat(np.where(cell < 64, one << (cell % 64).astype(np.uint64), np.uint64(0)), start)
            high = np.bitwise_or.reduceat(np.where(cell >= 64, one << (cell % 64 + 32).astype(np.uint64), np.uint64(0)), start)
            at = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(h)]))
            hot = est > HARMLESS
            salt = np.where(hot, rid[text] % SALTS, 0).astype(np.int32)
            more = np.flatnonzero(probe & hot)  # a probe of a hot bit goes to all its parts
            extra = np.repeat(more, SALTS - 1)
            other = (np.repeat(salt[more], SALTS - 1) + np.tile(np.arange(1, SALTS), len(more))) % SALTS
            use = np.flatnonzero(wanted[_cell(h)])
            rows = np.r_[use, extra]
            kind = np.r_[probe[use].astype(np.int64), np.full(len(extra), 2)]
            yield pa.RecordBatch.from_pydict({
                "h": pa.array(h[rows].view(np.int64)), "salt": pa.array(np.r_[salt[use], other.astype(np.int32)]), "rid": pa.array(rid[text[rows]]),
                "n": pa.array((n[text[rows]] * 64 + np.minimum(gain[part[rows]], 15) * 4 + kind).astype(np.int32)),
                "m": pa.array(mask[part[rows]] | high[at[rows]].view(np.int64)), "s": pa.array(low[at[rows]].view(np.int64)),
            })

    return reps.select("rid", "norm").mapInArrow(emit, "h bigint, salt int, rid bigint, n int, m bigint, s bigint")


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (h, salt) -> distinct candidate pairs of each block of probes.

    The columns are those of _probes. A group of equal (h, salt) is held in memory; salting keeps it near HARMLESS / SALTS rows.
    """
    block = 2_000_000

    def pairs(h: np.ndarray, salt: np.ndarray, rid: np.ndarray, n: np.ndarray, m: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.r_[True, (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])]
        at = np.flatnonzero(new)
        size = np.diff(np.r_[at, len(h)])
        group = np.cumsum(new) - 1
        kind, bits, gain = n % 4, n // 64, n // 4 % 16
        p = np.flatnonzero((kind > 0) & (size[group] > 1))
        cost = np.cumsum(size[group[p]])
        lo = 0
        while lo < len(p):
            hi = max(lo + 1, int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + block, "right")))
            q = p[lo:hi]
            k = size[group[q]]
            a = np.repeat(q, k)
            b = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(at[group[q]], k)
            ok = (kind[b] < 2) & (rid[a] != rid[b]) & (bits[b] >= bits[a]) & (bits[b] <= 2 * bits[a])
            a, b = a[ok], b[ok]
            lost = m[a] & ~m[b]
            ok = (np.bitwise_count(lost & 0xFFFFFFFF) < gain[a]) | (gain[a] == 15)
            lost = np.bitwise_count((lost >> 32) & 0xFFFFFFFF).astype(np.int32) + np.bitwise_count((s[a] & ~s[b]).view(np.uint64))
            ok &= 3 * (bits[a] - lost) >= bits[a] + bits[b]
            x, y = np.minimum(rid[a[ok]], rid[b[ok]]), np.maximum(rid[a[ok]], rid[b[ok]])
            order = np.lexsort((y, x))
            x, y = x[order], y[order]
            keep = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if len(x) else np.empty(0, bool)
            if keep.any():
                yield pa.RecordBatch.from_pydict({"a": pa.array(x[keep]), "b": pa.array(y[keep])})
            lo = hi

    held: list[np.ndarray] | None = None
    for batch in batches:
        cols = [batch.column(c).to_numpy() for c in ("h", "salt", "rid", "n", "m", "s")]
        if not len(cols[0]):
            continue
        if held is not None:
            cols = [np.r_[x, y] for x, y in zip(held, cols)]
        last = int(np.flatnonzero(np.r_[True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])])[-1])
        if last:
            yield from pairs(*[x[:last] for x in cols])
        held = [x[last:] for x in cols]
    if held is not None:
        yield from pairs(*held)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for s, t in zip(b.column("ta").to_pylist(), b.column("tb").to_pylist()):
            u, v = s.split(" "), t.split(" ")
            x, y = set(zip(u, u[1:], u[2:])), set(zip(v, v[1:], v[2:]))
            common = len(x & y)
            keep.append(3 * common >= len(x) + len(y))
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def near_duplicate_classes(rows: DataFrame, scratch: Scratch, id_col: str = "question_id", text_col: str = "question_text") -> tuple[DataFrame, DataFrame]:
    """(members(id, rid), links(a, b)): texts with the same words form one class, links join classes.

    rid is the class; links hold each unordered pair of classes with at least half of their runs of three
    words in common once. Null ids, null texts and texts of fewer than three words belong to no class.
    """
    own = rows.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w")).filter(F.col("id").isNotNull() & (F.size("w") >= RUN))
    own = own.select("id", F.array_join("w", " ").alias("norm"))
    keyed = own.select("id", "norm", F.xxhash64(F.lit(1), "norm").alias("k1"), F.xxhash64(F.lit(2), "norm").alias("k2"))
    reps = scratch.cut(keyed.groupBy("k1", "k2").agg(F.min("norm").alias("norm")).withColumn("rid", F.monotonically_increasing_id()), "reps")
    members = scratch.cut(keyed.select("id", "k1", "k2").distinct().join(reps.select("k1", "k2", "rid"), ["k1", "k2"]).select("id", "rid"), "members")
    sc = rows.sparkSession.sparkContext
    hist = sc.broadcast(_histogram(reps))
    probed = sc.broadcast(_probed_cells(reps, hist))
    found = _probes(reps, hist, probed).repartition("h", "salt").sortWithinPartitions("h", "salt").mapInArrow(_match, "a bigint, b bigint").distinct()
    pairs = found_pairs = scratch.cut(found, "candidates")
    text = reps.select("rid", "norm")
    hot = hot_keys(pairs, "b")
    pairs = salted_join(pairs, text.select(F.col("rid").alias("a"), F.col("norm").alias("ta")), "a")
    pairs = salted_join(pairs, text.select(F.col("rid").alias("b"), F.col("norm").alias("tb")), "b", hot=hot)
    links = scratch.cut(pairs.select("a", "b", "ta", "tb").mapInArrow(_verify, "a bigint, b bigint"), "links")
    scratch.drop(found_pairs)
    return members, links


def near_duplicate_pairs(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(question_id_1, question_id_2): every pair of different ids, smaller first, distinct.

    Repeated rows of an id give no further pairs; equal texts under different ids are pairs.
    """
    members, links = near_duplicate_classes(rows, scratch)
    left = members.select(F.col("rid").alias("a"), F.col("id").alias("p"))
    right = members.select(F.col("rid").alias("b"), F.col("id").alias("q"))
    across = salted_join(salted_join(links, left, "a"), right, "b", hot=hot_keys(links, "b")).select("p", "q").filter("p <> q")
    within = salted_join(left, right.withColumnRenamed("b", "a"), "a").select("p", "q").filter("p < q")
    both = across.unionByName(within)
    return both.select(F.least("p", "q").alias("question_id_1"), F.greatest("p", "q").alias("question_id_2")).distinct()


def near_duplicate_summary(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(question_id, class_id, class_links): one row per id and class; the number of other classes near it."""
    members, links = near_duplicate_classes(rows, scratch)
    ends = links.select(F.explode(F.array("a", "b")).alias("rid")).groupBy("rid").agg(F.count(F.lit(1)).alias("class_links"))
    names = members.groupBy("rid").agg(F.min("id").alias("class_id"))
    hot = hot_keys(members, "rid")
    out = salted_join(salted_join(members, names, "rid", hot=hot), ends, "rid", "left", hot=hot)
    return out.select(F.col("id").alias("question_id"), "class_id", F.coalesce("class_links", F.lit(0)).alias("class_links"))
