"""Problem 1: content that a record says again.

A logistic regression over hashed word and character n-grams scores every record. N-grams that occurred
before in the same text have buckets of their own, apart for those that begin a stretch and those that go on
with one; so have the n-grams of option labels. It is trained on a bounded sample of the rows, labelled by
the rule, half of them also with a part said again; its scores are calibrated on held-out rows. Records at or
above a fixed probability are candidates, and only these are measured by the rule; what the threshold loses
is measured on held-out rows (`Model.held`), not assumed to be nothing.
"""

from __future__ import annotations

import random
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.arrow import WORD, WordHash, runs, word_arrays

#: The rule: words of a run, least words of a text, least share.
RUN, LEAST_WORDS, SHARE = 5, 10, 0.3
#: Rows that the classifier is fitted on at most, each of them in one changed form more.
SAMPLE_ROWS = 3000
#: Buckets of n-grams, of repeated runs (begun, gone on with) and of repeated label n-grams.
PLAIN, AGAIN, LABELS = 1 << 14, 1 << 6, 1 << 4
#: Fixed probability from which a record is a candidate of the rule.
THRESHOLD = 0.0005
#: Scale of the values of repeated runs.
SCALE = 10.0
#: What labels of changed rows are made of, so that every bucket of labels is learned.
SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789"


def label_key(label: str | None) -> str:
    """A label as it is compared: width, case, blanks and punctuation don't matter."""
    return "".join(WORD.findall(unicodedata.normalize("NFKC", label).casefold())) if label else ""


def repeats_label(labels: list[str | None] | None) -> bool:
    """Two entries with the same label; entries without any letter or digit have no label."""
    keys = [k for k in map(label_key, labels or ()) if k]
    return len(set(keys)) < len(keys)


def later(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which runs occurred before in the same text; runs are in order of text and place."""
    order = np.lexsort((np.arange(len(hashes)), hashes, text))
    h, t = hashes[order], text[order]
    out = np.zeros(len(hashes), bool)
    out[order[1:]] = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
    return out


def repeated_share(word: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Share of each text's words that lie in a later occurrence of a run of RUN words; 0 for short texts."""
    h, text, at = runs(word, counts, RUN)
    covered = np.zeros(len(word) + 1, np.int64)
    if len(h):
        place = at[later(h, text)]
        np.add.at(covered, place, 1)
        np.add.at(covered, place + RUN, -1)
    hit = np.cumsum(covered)[:-1] > 0
    owner = np.repeat(np.arange(len(counts)), counts)
    sums = np.bincount(owner, hit, minlength=len(counts))
    return np.where(counts >= LEAST_WORDS, sums / np.maximum(counts, 1), 0.0)


@dataclass
class Features:
    """Sparse rows: bucket and value by row; plain n-grams of a row sum to 1."""

    row: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    n: int

    def take(self, keep: np.ndarray) -> Features:
        """The rows that keep marks, numbered anew."""
        use = keep[self.row]
        return Features((np.cumsum(keep) - 1)[self.row[use]], self.bucket[use], self.value[use], int(keep.sum()))


def features(texts: list[str | None], labels: list[list[str | None] | None], cache: WordHash) -> tuple[Features, np.ndarray, np.ndarray]:
    """(features, word hashes, words of each text). Buckets: plain, runs begun again, gone on with, labels again."""
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    joined, size = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            low = t.lower()
            w = WORD.findall(low)
            counts[i] = len(w)
            flat.extend([cache[x] for x in w])
            raw = low.encode()
            joined.append(raw)
            size[i] = len(raw)
    word = np.array(flat, np.uint64)
    parts = []
    for n in (1, 2):
        h, text, _ = runs(word, counts, n)
        parts.append((text, (h >> np.uint64(50)).astype(np.int64), 0.25))
    chars = np.frombuffer(b"".join(joined), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), size)
    if len(chars) > 3:
        h = (chars[:-3] << 24 | chars[1:-2] << 16 | chars[2:-1] << 8 | chars[3:]) * np.uint32(0x9E3779B1)
        same = owner[:-3] == owner[3:]
        parts.append((owner[:-3][same], (h[same] >> np.uint32(18)).astype(np.int64), 0.5))
    row, bucket, value = [], [], []
    for text, b, weight in parts:
        n = np.bincount(text, minlength=len(texts))
        row.append(text)
        bucket.append(b % PLAIN)
        value.append(weight / np.maximum(n[text], 1))
    h, text, at = runs(word, counts, RUN)
    again = later(h, text) if len(h) else np.zeros(0, bool)
    if again.any():
        k = np.flatnonzero(again)
        on = np.r_[False, (np.diff(at[k]) == 1) & (text[k][1:] == text[k][:-1])]
        row.append(text[k])
        bucket.append(PLAIN + np.where(on, AGAIN, 0) + (h[k] >> np.uint64(58)).astype(np.int64) % AGAIN)
        value.append(SCALE / np.maximum(counts[text[k]], 1))
    own, grams = [], []
    for i, x in enumerate(labels):
        seen: set[str] = set()
        for g in map(label_key, x or ()):
            if g and g in seen:
                own.append(i)
                grams.append(cache[g] % LABELS)
            seen.add(g)
    row.append(np.array(own, np.int64))
    bucket.append(PLAIN + 2 * AGAIN + np.array(grams, np.int64))
    value.append(np.ones(len(own)))
    return Features(np.concatenate(row).astype(np.int64), np.concatenate(bucket), np.concatenate(value), len(texts)), word, counts


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    #: Of the held-out rows: bins of probability with (rows, mean probability, share of positives), and recall at THRESHOLD.
    held: dict = field(default_factory=dict)

    def raw(self, x: Features) -> np.ndarray:
        return self.bias + np.bincount(x.row, self.weights[x.bucket] * x.value, minlength=x.n)

    def score(self, x: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -40, 40)))


def _fit(x: Features, y: np.ndarray, weight: np.ndarray, steps: int = 150, rate: float = 0.5, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression, by gradient steps of a size of its own for each bucket."""
    w, bias = np.zeros(PLAIN + 2 * AGAIN + LABELS), 0.0
    seen, seen_bias = np.full(len(w), 1e-8), 1e-8
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(x.row, w[x.bucket] * x.value, minlength=x.n), -40, 40)))
        g = (p - y) * weight / max(weight.sum(), 1e-9)
        grad = np.bincount(x.bucket, g[x.row] * x.value, minlength=len(w)) + decay * w
        seen += grad * grad
        seen_bias += g.sum() ** 2
        w -= rate * grad / np.sqrt(seen)
        bias -= rate * g.sum() / np.sqrt(seen_bias)
    return w, float(bias)


def train(x: Features, y: np.ndarray, natural: np.ndarray, seed: int = 5) -> Model:
    """Fit on one half of the rows; calibrate (Platt, smoothed) on a quarter; report on the last quarter.

    natural marks the rows that were not changed. Changed rows only teach: the calibration is moved to the
    natural rows' share of positives, smoothed by one row of each kind.
    """
    part = np.random.default_rng(seed).integers(0, 4, x.n)
    fit, tune = part < 2, part == 2
    if x.n < 40:
        fit = tune = np.ones(x.n, bool)
    few, many = max(1.0, y[fit].sum()), max(1.0, (1 - y[fit]).sum())
    w, bias = _fit(x.take(fit), y[fit], np.where(y[fit] > 0, many / few, 1.0))
    model = Model(w, bias, 1.0, 0.0)
    v, t = model.raw(x)[tune], y[tune]
    top, low = t.sum(), (1 - t).sum()
    want = np.where(t > 0, (top + 1) / (top + 2), 1 / (low + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * v + shift, -40, 40)))
        r = p * (1 - p) + 1e-6
        h = np.array([[(r * v * v).sum() + 1e-3, (r * v).sum()], [(r * v).sum(), r.sum() + 1e-3]])
        move = np.linalg.solve(h, [((p - want) * v).sum() + 1e-3 * (slope - 1), (p - want).sum()])
        slope, shift = max(0.05, slope - float(np.clip(move[0], -0.5, 0.5))), shift - float(np.clip(move[1], -2, 2))
    odds = lambda n, of: np.log((n + 1) / (of - n + 1))
    nat = natural & tune
    model.slope, model.shift = slope, shift + odds(y[nat].sum(), nat.sum()) - odds(top, len(t))
    held = (part == 3) if x.n >= 40 else fit
    p = model.score(x)
    edges, bins = [0.0, THRESHOLD, 0.03, 0.1, 0.3, 0.7, 1.0], []
    for lo, hi in zip(edges, edges[1:]):
        use = held & natural & (p >= lo) & ((p < hi) | (hi == 1.0))
        bins.append((lo, int(use.sum()), float(p[use].mean()) if use.any() else 0.0, float(y[use].mean()) if use.any() else 0.0))
    true = held & (y > 0)
    model.held = {"bins": bins, "positives": int(true.sum()), "recall": float((p[true] >= THRESHOLD).mean()) if true.any() else 1.0, "candidates": float((p[held & natural] >= THRESHOLD).mean()) if (held & natural).any() else 0.0}
    return model


def _changed(rng: random.Random, text: str, labels: list[str | None] | None) -> tuple[str, list[str | None] | None]:
    """A row in which something is said again: stretches of any length and number, or a label."""
    w = text.split()
    if rng.random() < 0.25:
        known = [x for x in labels or () if x] or ["a", "b", "c", "d"]
        again = rng.choice(known) if rng.random() < 0.3 else f"{rng.choice(SIGNS)}{rng.choice(('', '', '', rng.choice(SIGNS)))}"
        return text, [*known, again, again]
    for _ in range(rng.randint(1, 3)):
        if len(w) < RUN:
            break
        n = rng.randint(RUN, max(RUN, len(w) // 2))
        i = rng.randrange(len(w) - n + 1) if len(w) > n else 0
        at = rng.randint(0, len(w))
        w[at:at] = w[i : i + n]
    return " ".join(w), labels


def fit_model(rows: DataFrame, id_col: str, text_col: str) -> Model:
    """The model, fitted on the SAMPLE_ROWS rows whose texts hash lowest and on as many changed ones."""
    sample = rows.select(F.col(text_col).alias("text"), F.col("options.label").alias("labels")).filter("text is not null")
    sample = sample.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_ROWS).toArrow()
    texts, labels = sample["text"].to_pylist(), sample["labels"].to_pylist()
    if not texts:
        return Model(np.zeros(PLAIN + 2 * AGAIN + LABELS), -20.0, 1.0, 0.0)
    rng = random.Random(7)
    more = [_changed(rng, t, v) for t, v in zip(texts, labels)]
    while len(texts) + len(more) < 400:  # a small table teaches by more changed rows
        more.append(_changed(rng, *rng.choice(more)))
        more.append((" ".join(rng.sample(more[-1][0].split(), len(more[-1][0].split()))), None))
    natural = np.arange(len(texts) + len(more)) < len(texts)
    texts, labels = texts + [t for t, _ in more], labels + [v for _, v in more]
    x, word, counts = features(texts, labels, WordHash())
    y = (repeated_share(word, counts) >= SHARE) | np.array([repeats_label(v) for v in labels], bool)
    return train(x, y.astype(float), natural)


def measure_repetition(rows: DataFrame, model: Model | None = None, id_col: str = "question_id", text_col: str = "question_text") -> DataFrame:
    """(question_id, probability, repeated_share, label_repeated), one row per input row.

    repeated_share and label_repeated are those of the rule, for every row. A null text has no words; null
    options and null labels repeat nothing.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model or fit_model(rows, id_col, text_col))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        for b in batches:
            texts, labels = b.column("text").to_pylist(), b.column("labels").to_pylist()
            x, word, counts = features(texts, labels, cache)
            p = shared.value.score(x)
            share, label = repeated_share(word, counts), np.array([repeats_label(v) for v in labels], bool)
            yield pa.RecordBatch.from_pydict({"question_id": b.column("id"), "probability": pa.array(p), "repeated_share": pa.array(share), "label_repeated": pa.array(label)})

    source = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col("options.label").alias("labels"))
    return source.mapInArrow(score, f"question_id {dict(rows.dtypes)[id_col]}, probability double, repeated_share double, label_repeated boolean")


def repeated_shares(rows: DataFrame) -> DataFrame:
    """(question_id, repeated_share), distinct: the share of every question_id, one row for each of its texts'
    shares. Short and null texts have the share 0; null ids have no row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        for b in batches:
            share = repeated_share(*word_arrays(b.column("question_text").to_pylist(), cache))
            yield pa.RecordBatch.from_pydict({"question_id": b.column("question_id"), "repeated_share": pa.array(share, pa.float64())})

    source = rows.filter("question_id is not null").select("question_id", "question_text")
    return source.mapInArrow(measure, f"question_id {dict(rows.dtypes)['question_id']}, repeated_share double").distinct()


def repeating_records(rows: DataFrame) -> DataFrame:
    """(question_id) of records with a repeated share of SHARE or more, or a repeated option label; distinct.

    The records come from the classifier's candidates; the rule then decides among them.
    """
    found = measure_repetition(rows).filter(F.col("probability") >= THRESHOLD).filter((F.col("repeated_share") >= SHARE) | F.col("label_repeated"))
    return found.filter("question_id is not null").select("question_id").distinct()
