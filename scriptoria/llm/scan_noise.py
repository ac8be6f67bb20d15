"""Problem 6: noise in text from scanned pages.

A character editor reads words and chooses for every character to keep it, replace it, delete it or insert
after it, and for every broken word whether to join the line end; it is an averaged perceptron over the edit,
its neighbours and how much more often the edited word occurs in the corpus, trained here on words of the
corpus that it spoils and breaks itself. A second perceptron tells running headers and page numbers by their
place on the page, the share of their document's pages and their form; it is trained on pages into which
headers, titles and numbers are planted. Both decide by the sign or order of their scores alone. Corpus
counts cover all texts; they live in a table of fixed size.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.operators.skew import hot_keys, salted_join
from scriptoria.session import Scratch

#: Cells of each of the two rows of word counts, whatever the corpus.
CELL_BITS = 21
#: Words the editor is trained on at most, and how often each is spoiled; texts and pages that words and planted pages come from.
TRAIN_WORDS, SPOILED, SAMPLE_TEXTS, SAMPLE_PAGES = 3000, 2, 4000, 3000
#: Words with misread characters from which a record has the noise `chars`.
MISREAD_WORDS = 3
#: Pages of a document that a line must return on to be its header.
HEADER_PAGES = 3
#: Letters of a header's key from which it is also looked for inside lines; shorter keys are too common there.
HEADER_LETTERS = 6
#: Letters of one word that the editor takes for others are fewer than these.
EDITS = 3
#: Shorter runs of letters are too short to tell, longer ones are no words.
SHORTEST_WORD, LONGEST_WORD = 4, 64

#: What scanning makes of letters (left as read, right as printed).
CONFUSIONS = {
    "c": "e", "!": "i", "|": "i", "@": "a", "0": "o", "ri": "n", "5": "s", "1": "l", "f": "t", "ii": "u", "li": "h", "cl": "d", "rn": "m", "9": "g", "6": "b", "l": "i", "vv": "w", "$": "s", "8": "b", "ﬁ": "fi", "ﬂ": "fl",
}

#: A word as the scan has it: letters, digits and the signs that stand for letters.
TOKEN = re.compile(r"[\w@|!$]+")
LETTER = re.compile(r"[^\W\d_]")
#: A word broken in two: hyphen of any kind, blanks or a line end, and the rest in lower case.
BREAK = re.compile(r"([^\W\d_]{2,})(-[ \t]*\n[ \t]*|-[ \t]+|[‐¬­][ \t]*\n?[ \t]*)([^\W\d_]+)")
DIGIT_INSIDE = re.compile(r"[a-z]{2}[0-9@|!$][a-z]{2}")
OWN_HYPHEN = re.compile(r"([^\W\d_]{2,})-([^\W\d_]{2,})")
#: How a page number is printed on its own line (n: the number, t: the number of pages, r: a roman number).
PAGE_FORMS = (
    "n", "n | page", "page n", "page n of t", "page n/t", "n/t", "n of t", "- n -", "– n –", "~ n ~", "[n]", "(n)", "[ n ]", "p. n", "p n", "pg. n", "pg n", "seite n", "seite n von t", "s. n", "página n", "página n de t",
    "pág. n", "page n sur t", "r", "- r -", "[r]", "(r)", "~ r ~",
)
EDGE_NUMBER = re.compile(r"^\W*(?:p(?:age|\.)\s*)?\d{1,4}\s+(?=\S)|(?<=\S)\s+\W*(?:p(?:age|\.)\s*)?\d{1,4}\W*$", re.I)
#: Beside a header inside a text: the rest of a word, the next words, a page number.
WORD_END, WORD_BEGIN = re.compile(r"[\w@|!$]*\Z"), re.compile(r"[\w@|!$]*")
LAST_WORD, NEXT_WORD = re.compile(r"([\w@|!$]+)\s+\Z"), re.compile(r"\s+([\w@|!$]+)")
NUMBER_BEFORE = re.compile(r"(?:(?:^|(?<=\n))\W*(?:p(?:age|\.)\s*)?\d{1,4}|\bp(?:age|\.)\s*\d{1,4})[ \t]+(?:[|·–—-][ \t]*)?\Z", re.I)
NUMBER_AFTER = re.compile(r"[ \t]+(?:[|·–—-][ \t]*)?(?:(?:p(?:age|\.)\s*)\d{1,4}\b|\d{1,4}[ \t]*(?=\n|\Z))", re.I)
LABEL = re.compile(r"\s*(?:[a-h]|\d{1,3})\s?[-.):·]\s*\S", re.I)
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl"}
LIGATURE = re.compile("[ﬀ-ﬄ]")
#: Letters that scanning changes into others are left out of a line's key, or told as one.
FOLD = str.maketrans({c: None for c in "rinulhcedmvw1!|¡"} | {"f": "t", "0": "o", "5": "s", "$": "s", "9": "g", "6": "b", "8": "b", "@": "a"})
NUMBER = re.compile(r"\d+")
ROMAN_NUMBER = re.compile(r"[ivxlc]+")
SHAPES = {x for f in PAGE_FORMS for x in (f, re.sub(r"[ .:,]", "", f))}
ROMAN = re.compile(r"[-–—~\[(]?\s*(?=[ivxlc]+\b)(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})\s*[-–—~\])]?", re.I)


class Lexicon:
    """Counts of words in two rows of cells; the smaller of a word's two cells bounds its count from above."""

    def __init__(self, cells: np.ndarray):
        self.first, self.second = cells[0], cells[1]
        self.mask = len(cells[0]) - 1
        self.kept: dict[str, int] = {}

    def __call__(self, word: str) -> int:
        n = self.kept.get(word)
        if n is None:
            h = xxhash.xxh64_intdigest(word)
            n = min(int(self.first[h & self.mask]), int(self.second[(h >> 32) & self.mask]))
            if len(self.kept) > 400_000:
                self.kept.clear()
            self.kept[word] = n
        return n


def _plain(text: str) -> str:
    return text if text.isascii() else LIGATURE.sub(lambda m: LIGATURES[m[0]], text)


def _tokens(text: str) -> list[str]:
    return TOKEN.findall(_plain(text.lower()))


def word_counts(texts: DataFrame) -> np.ndarray:
    """Both rows of cells over the column text of all rows; at most 2 * 2**CELL_BITS numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        sums = np.zeros(2 << CELL_BITS, np.int64)

        def flush() -> None:
            h = np.array([xxhash.xxh64_intdigest(w) for w in seen], np.uint64)
            n = np.array(list(seen.values()), np.int64)
            mask = np.uint64((1 << CELL_BITS) - 1)
            np.add.at(sums, (h & mask).astype(np.int64), n)
            np.add.at(sums, ((h >> np.uint64(32)) & mask).astype(np.int64) + (1 << CELL_BITS), n)
            seen.clear()

        for b in batches:
            for t in b.column("text").to_pylist():
                if t:
                    seen.update(_tokens(t))
            if len(seen) > 300_000:
                flush()
        if seen:
            flush()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(at.astype(np.int32)), "n": pa.array(sums[at])})

    got = texts.select("text").mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(2 << CELL_BITS, np.int64)
    cells[got["cell"].to_numpy()] = got["n"].to_numpy()
    return cells.reshape(2, -1)


def _maybe_broken(text: str) -> bool:
    """Whether a mark of a broken word follows two letters anywhere."""
    i = text.find("-")
    while i >= 0:
        if text[i + 1 : i + 2] in (" ", "\n", "\t") and text[max(0, i - 2) : i].isalpha() and i > 1:
            return True
        i = text.find("-", i + 1)
    return not text.isascii() and any(c in text for c in "‐¬\xad")


def _sites(word: str) -> list[tuple[int, str, str]]:
    """(place, as read, as printed) of everything in the word that scanning may have made."""
    out = []
    for i in range(len(word)):
        for size in (1, 2):
            part = word[i : i + size]
            if len(part) == size and part in CONFUSIONS:
                out.append((i, part, CONFUSIONS[part]))
    return out


def _apply(word: str, edits: tuple[tuple[int, str, str], ...]) -> str | None:
    """The word with the edits made; None where they overlap."""
    out, at = [], 0
    for i, read, printed in edits:
        if i < at:
            return None
        out += [word[at:i], printed]
        at = i + len(read)
    return "".join(out) + word[at:]


def _steps(name: tuple, n: int, base: int, lo: int, hi: int) -> list[tuple]:
    """How much more often than base n is, as one feature for every power of two that is reached."""
    r = math.floor(math.log2((n + 0.5) / (base + 0.5)))
    return [(*name, k) for k in range(lo, min(r, hi) + 1)]


class Perceptron:
    """Weights of named features; averaged over all steps of the training."""

    def __init__(self, weights: dict[tuple, float] | None = None):
        self.weights = weights or {}

    def score(self, features: list[tuple]) -> float:
        get = self.weights.get
        return sum([get(f, 0.0) for f in features])


class _Trainer:
    """Updates of an averaged perceptron."""

    def __init__(self, model: Perceptron):
        self.model, self.step = model, 0
        self.weights: dict[tuple, float] = defaultdict(float)
        self.sums: dict[tuple, float] = defaultdict(float)
        model.weights = self.weights

    def move(self, features: list[tuple], by: float) -> None:
        for f in features:
            self.weights[f] += by
            self.sums[f] += by * self.step

    def yes_or_no(self, features: list[tuple], want: bool) -> None:
        self.step += 1
        if (self.model.score(features) > 0) != want:
            self.move(features, 1 if want else -1)

    def done(self) -> None:
        self.model.weights = {f: w - self.sums[f] / max(1, self.step) for f, w in self.weights.items()}


class Editor(Perceptron):
    """Averaged perceptron over edits of characters; an edit is keep, replace, delete, insert or join.

    An edit of two characters into one replaces the first and deletes the second, one of one into two replaces
    it and inserts another; a join deletes the mark and the line end. The score of a reading is the sum over
    its edits and what the corpus says of the word; the reading with the highest score stands.
    """

    @staticmethod
    def features(word: str, edits: tuple[tuple[int, str, str], ...], n: int, base: int) -> list[tuple]:
        if not edits:
            return [("keep",), ("keep", "seen" if base > 1 else "unseen")]
        inside = bool(DIGIT_INSIDE.search(word))
        out: list[tuple] = [("edit",), ("edits", min(len(edits), 3)), ("known", n > 0, inside), ("sign" if len(edits) == 1 and not edits[0][1].isalpha() else "letters", n > 0)]
        out += _steps(("ratio",), n, base, -2, 9)
        for i, read, printed in edits:
            op = ("replace" if len(read) == len(printed) else "replace-delete" if len(read) > len(printed) else "replace-insert", read, printed)
            before, after = word[i - 1] if i else "^", word[i + len(read)] if i + len(read) < len(word) else "$"
            out += [(op,), (op, "before", before), (op, "after", after), (op[0], "digit" if read[0].isdigit() else "sign" if not read[0].isalpha() else "letter", n > 0)]
        return out

    @staticmethod
    def join_features(mark: str, n: int, a: int, b: int) -> list[tuple]:
        """Of a word in two parts with the counts a and b, n as a whole."""
        kind = ("hyphen" if mark[0] == "-" else "soft") + (" at a line's end" if "\n" in mark else "")
        low = min(a, b)
        return [("join", kind), ("join", kind, "whole", n > 0), ("join", kind, "parts", min(low, 2), n > 0), *_steps(("join", kind, "ratio"), n, low, -8, 5)]

    def joins(self, mark: str, n: int, a: int, b: int) -> bool:
        return self.score(self.join_features(mark, n, a, b)) > 0

    def readings(self, word: str, lexicon: Lexicon) -> Iterator[tuple[tuple, str, int]]:
        """(edits, word, count) of the word itself, of all its repaired forms that occur and of the form in which
        only digits and signs are others: each of them is printed as a letter, and fewer than EDITS letters are others."""
        yield (), word, lexicon(word)
        sites = _sites(word)
        must = tuple(s for s in sites if not s[1].isalpha() or s[1] in LIGATURES)
        free = [s for s in sites if s[1].isalpha() and s[1] not in LIGATURES]
        for n in range(0 if must else 1, EDITS):
            for more in combinations(free, n):
                edits = tuple(sorted(must + more)) if must else more
                made = _apply(word, edits)
                if made is not None and ((count := lexicon(made)) or not more):
                    yield edits, made, count

    def read(self, word: str, lexicon: Lexicon, base: int | None = None, hide: bool = False) -> tuple[tuple, str, int]:
        """(edits, word, count) of the best reading. base: the word's count, if another; hide: as if no word occurred."""
        base, best = lexicon(word) if base is None else base, None
        for edits, made, n in self.readings(word, lexicon):
            if hide and edits:
                n = 0
            s = self.score(self.features(word, edits, n, base))
            if best is None or s > best[0]:
                best = (s, edits, made, n)
        return best[1:]

    @classmethod
    def train(cls, words: list[str], lexicon: Lexicon, signs: list[str] = (), compounds: list[tuple[str, str]] = (), epochs: int = 4, seed: int = 11) -> Editor:
        """Fit on words that are spoiled and broken here, and on words as they are.

        signs: words of the corpus that hold digits of their own; compounds: both parts of words with a hyphen of their own.
        """
        rng, spoil = random.Random(seed), defaultdict(list)
        for read, printed in CONFUSIONS.items():
            spoil[printed].append(read)
        cases: list[tuple] = [("read", w, (), None, False) for w in signs]
        for w in words:
            cases.append(("read", w, (), max(1, lexicon(w) >> rng.randint(0, 3)), False))
            places = [(i, p) for p in spoil for i in range(len(w)) if w.startswith(p, i)]
            for _ in range(SPOILED if places else 0):
                i, printed = rng.choice(places)
                read = rng.choice(spoil[printed])
                odd = (not read.isalpha() or read in LIGATURES) and rng.random() < 0.3
                cases.append(("read", w[:i] + read + w[i + len(printed) :], ((i, read, printed),), None, odd))
            if len(w) >= 6:
                k = rng.randint(2, len(w) - 2)
                for mark in ("-\n", "- ", "\xad\n", "\xad"):
                    cases.append(("join", mark, 0 if "\n" in mark and rng.random() < 0.2 else lexicon(w), lexicon(w[:k]), lexicon(w[k:]), True))
                cases += [("join", mark, 0, lexicon(w[:k]), lexicon(w[k:]), False) for mark in ("- ", "\xad")]
                if rng.random() < 0.25:  # a piece of a word is no misread one
                    cases.append(("read", w[k:] if rng.random() < 0.5 else w[:k], (), None, False))
            v = rng.choice(words)
            cases += [("join", mark, lexicon(w + v), lexicon(w), lexicon(v), False) for mark in ("-\n", "- ")]
        cases += [("join", mark, lexicon(a + b), lexicon(a), lexicon(b), False) for a, b in compounds for mark in ("-\n", "- ")]
        editor = cls()
        trainer = _Trainer(editor)
        for _ in range(epochs):
            rng.shuffle(cases)
            for kind, *case in cases:
                if kind == "join":
                    mark, n, a, b, want = case
                    trainer.yes_or_no(cls.join_features(mark, n, a, b), want)
                    continue
                word, gold, base, hide = case
                trainer.step += 1
                edits, made, n = editor.read(word, lexicon, base, hide)
                want = _apply(word, gold)
                if made == want:
                    continue
                base = lexicon(word) if base is None else base
                trainer.move(cls.features(word, gold, 0 if hide else lexicon(want), base), 1)
                trainer.move(cls.features(word, edits, n, base), -1)
        trainer.done()
        return editor


class Furniture(Perceptron):
    """Averaged perceptron over lines: which are page numbers, and which keys of a document are running headers."""

    @staticmethod
    def number_features(line: str, place: int, filled: int, page: bool) -> list[tuple] | None:
        """place: of the line among the filled ones, from 0. None: no line that a number could be."""
        shape = page_shape(line)
        if shape is None:
            return None
        edge = min(place, filled - 1 - place) if page else 0 if filled > 1 else 9
        where = "edge" if edge < 2 else "inside"
        return [("number", where), ("number", shape, where), ("number", "word" if any(c in shape for c in "pgsá") else "bare", where)]

    @staticmethod
    def header_features(pages: int, doc_pages: int, top: int, bottom: int, forms: int, numbered: int, letters: int, others: float) -> list[tuple]:
        """others: share of the other documents that have the key as well."""
        out: list[tuple] = [("header",), ("header", "pages", min(pages, 6)), ("header", "letters", min(letters // 3, 3)), ("header", "numbers", numbered > 0), ("header", "forms", forms > 1)]
        out += [("header", "share", k) for k in range(1, 8 * pages // max(doc_pages, pages) + 1)]
        out += [("header", "side", k) for k in range(2, 4 * max(top, bottom) // max(1, top + bottom) + 1)]
        return out + [("header", "others", k) for k, least in enumerate((0.0, 0.002, 0.01, 0.05)) if others > least]

    def is_number(self, line: str, place: int, filled: int, page: bool) -> bool:
        f = self.number_features(line, place, filled, page)
        return f is not None and self.score(f) > 0

    @classmethod
    def train(cls, documents: list[list[str]], words: list[str], epochs: int = 4, seed: int = 12) -> Furniture:
        """Fit on documents (the texts of their pages) into which headers, titles and numbers are planted."""
        rng = random.Random(seed)
        words = sorted(words) or ["notes", "review", "wall"]
        phrase = lambda: " ".join(rng.choice(words).capitalize() for _ in range(rng.randint(2, 5)))
        titles, series = [phrase() for _ in range(12)], [phrase() for _ in range(8)]
        cases: list[tuple[list[tuple], bool]] = []
        stats: dict[tuple[int, str], dict] = {}
        label: dict[tuple[int, str], bool] = {}
        for d, pages in enumerate(documents):
            head, at_top = rng.choice(series) if rng.random() < 0.1 else phrase(), rng.random() < 0.5
            often, mine = rng.uniform(0.3, 1.0), {t: (rng.uniform(0.1, 0.9), rng.choice([0, 1, -1, None, None])) for t in rng.sample(titles, 3)}
            label |= {(d, line_key(head)[0]): True} | {(d, line_key(t)[0]): False for t in mine}
            for p, text in enumerate(pages, rng.randint(1, 200)):
                lines = _lines(text)
                lines = [s for s in lines if page_shape(s) is None] or ["x"]
                for t, (rate, at) in mine.items():
                    if rng.random() < rate:
                        shown = t if rng.random() < 0.8 else f"{t} {rng.choice(words)}"
                        lines.insert(rng.choice([0, 1, len(lines), rng.randint(0, len(lines))]) if at is None else at if at >= 0 else len(lines), rng.choice([t, t, t, t.upper(), shown]))
                if rng.random() < often:
                    shown = rng.choice([head, head, head.upper(), head.replace("e", "c", 1), head.replace(" ", "  ", 1)])
                    shown = rng.choice([shown, shown, f"{p} {shown}", f"{shown} {p}"])
                    lines.insert(0 if at_top else len(lines), shown)
                number = page_form(rng, p)
                place = rng.choice([0, len(lines)])
                inner = [i for i in range(3, len(lines) - 3)]
                for i, s in enumerate(lines):
                    if (f := cls.number_features(s, i, len(lines), True)) is not None:
                        cases.append((f, False))
                cases.append((cls.number_features(number, place, len(lines) + 1, True), True))
                if inner:
                    cases.append((cls.number_features(page_form(rng, p), rng.choice(inner), len(lines) + 1, True), False))
                cases.append((cls.number_features(number, 1, 3, False), True))
                cases.append((cls.number_features(number, 0, 1, False), False))
                for key, sides, top, beside, shown in edge_lines("\n".join(lines), lambda s, i, n: False):
                    x = stats.setdefault((d, key), {"pages": set(), "top": 0, "bottom": 0, "forms": set(), "numbered": 0})
                    x["pages"].add(p)
                    x["top" if top else "bottom"] += 1
                    x["forms"].add(shown)
                    x["numbered"] += beside
        docs = Counter(key for (_, key), x in stats.items())
        for (d, key), x in stats.items():
            if (d, key) in label and len(x["pages"]) >= HEADER_PAGES:
                f = cls.header_features(len(x["pages"]), len(documents[d]), x["top"], x["bottom"], len(x["forms"]), x["numbered"], len(key), (docs[key] - 1) / (len(documents) + 20))
                cases += [(f, label[d, key])] * (4 if label[d, key] else 12)
        model = cls()
        trainer = _Trainer(model)
        for _ in range(epochs):
            rng.shuffle(cases)
            for f, want in cases:
                trainer.yes_or_no(f, want)
        trainer.done()
        return model


class _Flags(dict):
    """1 for a misread word, 0 for others, by word."""

    def __init__(self, reader: Reader):
        self.reader = reader

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        n = self[word] = int(self.reader.word(word) != word)
        return n


class _Printed(dict):
    """The word as printed, in its own letter case, by word."""

    def __init__(self, reader: Reader):
        self.reader = reader

    def __missing__(self, word: str) -> str:
        if len(self) > 400_000:
            self.clear()
        low = word.lower()
        made = self.reader.word(low)
        made = word if made == low else made.upper() if word.isupper() else made[:1].upper() + made[1:] if word[0].isupper() else made
        self[word] = made
        return made


class Reader:
    """What an executor needs to judge texts; words are judged once and kept."""

    def __init__(self, editor: Editor, lexicon: Lexicon):
        self.editor, self.lexicon, self.kept = editor, lexicon, {}
        self.flags, self.printed = _Flags(self), _Printed(self)

    def word(self, word: str) -> str:
        """The word as printed: the editor's best reading."""
        made = self.kept.get(word)
        if made is None:
            made = word
            bare = word.rstrip("!|")  # an exclamation mark or a bar may follow
            if SHORTEST_WORD <= len(bare) <= LONGEST_WORD and LETTER.search(bare):
                made = self.editor.read(bare, self.lexicon)[1] + word[len(bare) :]
            if len(self.kept) > 400_000:
                self.kept.clear()
            self.kept[word] = made
        return made

    def joins(self, first: str, mark: str, rest: str) -> bool:
        """Whether a word was broken here; its rest goes on in lower case."""
        if rest[0].isupper() and not first.isupper():
            return False
        first, rest = _plain(first), _plain(rest)
        whole = self.word((first + rest).lower())
        return self.editor.joins(mark, self.lexicon(whole), self.lexicon(first.lower()), self.lexicon(rest.lower()))

    def judge(self, text: str) -> tuple[int, bool]:
        """(words with misread characters, whether a word is broken)."""
        broken = False
        if _maybe_broken(text):
            text = _plain(text)
            whole = self.join(text)
            broken, text = whole != text, whole
        return sum(map(self.flags.__getitem__, _tokens(text))), broken

    def join(self, text: str) -> str:
        return BREAK.sub(lambda m: m[1] + m[3] if self.joins(m[1], m[2], m[3]) else m[0], text)


def fold(text: str) -> str:
    """The text without case, blanks, signs, numbers and what scanning confuses."""
    return re.sub(r"[\W\d_]+", "", _plain(text.lower()).translate(FOLD))


def line_key(line: str) -> tuple[str, bool]:
    """(the folded line without a page number at its side; whether there is one)."""
    plain = EDGE_NUMBER.sub("", line)
    return fold(plain), plain != line


def silent_sides(line: str) -> str:
    """The words before and after the first and last one that fold to something, with a tab between."""
    words = EDGE_NUMBER.sub("", line).lower().split()
    loud = [i for i, w in enumerate(words) if fold(w)]
    return " ".join(words[: loud[0]]) + "\t" + " ".join(words[loud[-1] + 1 :]) if loud else "\t"


def _alike(a: str, b: str) -> bool:
    return not fold(a) and SequenceMatcher(None, a.lower(), b).ratio() >= 0.6


def cut_headers(text: str, headers: dict[str, str]) -> str:
    """The text without every span that folds to a header's key, and without a page number beside it.

    headers: silent_sides by key. A span is widened to whole words and to the header's silent words at its
    sides, which fold to nothing. A bare number is a page number only between the header and the line's end.
    """
    whole = fold(text)
    for head in sorted((h for h in headers if h in whole), key=lambda h: (-len(h), h)):
        while True:
            keys = [fold(c) for c in text]
            place = [i for i, k in enumerate(keys) for _ in k]
            at = "".join(keys).find(head)
            if at < 0:
                break
            begin, end = place[at], place[at + len(head) - 1] + 1
            begin -= len(WORD_END.search(text[:begin])[0])
            end += len(WORD_BEGIN.match(text, end)[0])
            before, after = headers[head].split("\t")
            for word in reversed(before.split()):
                m = LAST_WORD.search(text[:begin])
                if m and _alike(m[1], word):
                    begin = m.start(1)
            for word in after.split():
                m = NEXT_WORD.match(text, end)
                if m and _alike(m[1], word):
                    end = m.end(1)
            if m := NUMBER_BEFORE.search(text[:begin]):
                begin = m.start()
            if m := NUMBER_AFTER.match(text, end):
                end = m.end()
            left, right = text[:begin].rstrip(" \t"), text[end:].lstrip(" \t")
            if (not left or left[-1] == "\n") and right[:1] == "\n":
                right = right[1:]
            text = left + ("" if not left or not right or "\n" in (left[-1], right[0]) else " ") + right
    return text


def page_shape(line: str) -> str | None:
    """The form of PAGE_FORMS that the line has; None if it has none."""
    s = " ".join(line.lower().split())
    if not 0 < len(s) <= 40:
        return None
    if not any(map(str.isdigit, s)):
        if len(s) < 2 or not ROMAN.fullmatch(s):
            return None
        s = ROMAN_NUMBER.sub("r", s)
    else:
        found = NUMBER.findall(s)
        if len(found) > 2 or any(len(x) > 4 for x in found):
            return None
        s = NUMBER.sub("n", s, count=1)
        s = NUMBER.sub("t", s)
    return s if s in SHAPES or (s := re.sub(r"[ .:,]", "", s)) in SHAPES else None


def page_form(rng: random.Random, p: int) -> str:
    """A page number in a form of PAGE_FORMS."""
    roman = lambda n: "".join((("", "x", "xx", "xxx", "xl", "l", "lx", "lxx", "lxxx", "xc")[n % 100 // 10], ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")[n % 10])) or "xi"
    form = rng.choice(PAGE_FORMS)
    out = re.sub(r"\b[ntr]\b", lambda m: {"n": str(p), "t": str(p + 40), "r": roman(p) if len(roman(p)) > 1 else "xi"}[m[0]], form)
    return out if rng.random() < 0.5 else out.capitalize()


def _lines(text: str) -> list[str]:
    return [s for s in text.split("\n") if s.strip()]


def edge_lines(text: str, is_number) -> Iterator[tuple[str, str, bool, bool, str]]:
    """(key, silent sides, whether at the top, whether beside a number, line) of the lines at a page's top and bottom that may be a header."""
    lines = _lines(text)
    n = len(lines)
    for i in dict.fromkeys([*range(min(2, n)), *range(max(0, n - 2), n)]):
        s = lines[i]
        if len(s) <= 120 and not LABEL.match(EDGE_NUMBER.sub("", s)) and not is_number(s, i, n):
            key, beside = line_key(s)
            if len(key) >= 2:
                yield key, silent_sides(s), i < 2 and i * 2 < n, beside, s


def header_keys(pages: DataFrame, furniture, scratch: Scratch) -> DataFrame:
    """(document_id, head, sides): keys and silent sides of the running headers among the lines that return at
    top or bottom of HEADER_PAGES or more pages of a document. furniture: the broadcast perceptron."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Furniture = furniture.value
        for b in batches:
            rows = []
            for d, p, t in zip(b.column("document_id").to_pylist(), b.column("page").to_pylist(), b.column("text").to_pylist()):
                rows.append((d, p, "", "", None, None, None))
                rows += [(d, p, key, sides, int(top), int(beside), xxhash.xxh64_intdigest(s) >> 1) for key, sides, top, beside, s in edge_lines(t or "", lambda s, i, n: model.is_number(s, i, n, True))]
            cols = list(zip(*rows)) or [()] * 7
            kinds = {"document_id": pa.string(), "page": pa.int32(), "head": pa.string(), "sides": pa.string(), "top": pa.int32(), "beside": pa.int32(), "form": pa.int64()}
            yield pa.RecordBatch.from_pydict({k: pa.array(c, t) for (k, t), c in zip(kinds.items(), cols)})

    rows = pages.select("document_id", F.col("page").cast("int"), "text").filter("document_id is not null and page is not null and text is not null")
    seen = rows.mapInArrow(edges, "document_id string, page int, head string, sides string, top int, beside int, form bigint").groupBy("document_id", "head", "page").agg(F.max("sides").alias("sides"), F.max("top").alias("top"), F.max("beside").alias("beside"), F.min("form").alias("form"))
    seen = seen.groupBy("document_id", "head").agg(F.count(F.lit(1)).alias("pages"), F.max("sides").alias("sides"), F.sum("top").alias("top"), F.sum("beside").alias("beside"), F.countDistinct("form").alias("forms"))
    seen = scratch.cut(seen, "edges")
    size = seen.filter("head = ''").select("document_id", F.col("pages").alias("doc_pages"))
    total = size.count()
    heads = seen.filter("head <> ''")
    docs = heads.groupBy("head").agg(F.count(F.lit(1)).alias("docs"))
    cand = salted_join(heads.filter(F.col("pages") >= HEADER_PAGES).join(size, "document_id"), docs, "head")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Furniture = furniture.value
        for b in batches:
            x = {c: b.column(c).to_pylist() for c in ("pages", "doc_pages", "top", "forms", "beside", "head", "docs")}
            keep = [model.score(model.header_features(p, dp, top, p - top, forms, beside, len(head), (docs - 1) / (total + 20))) > 0 for p, dp, top, forms, beside, head, docs in zip(*x.values())]
            yield b.select(["document_id", "head", "sides"]).filter(pa.array(keep, pa.bool_()))

    return cand.mapInArrow(decide, "document_id string, head string, sides string")


def fit_models(texts: DataFrame, pages: DataFrame) -> tuple[Editor, Furniture, np.ndarray]:
    """(editor, furniture, word counts). Both are fitted on bounded samples: words of the SAMPLE_TEXTS texts whose
    hash is lowest, and whole documents, in order of hash, of SAMPLE_PAGES pages together (the longest first 50 of each)."""
    cells = word_counts(texts)
    lexicon = Lexicon(cells)
    sample = texts.filter("text is not null").orderBy(F.xxhash64("text"), "text").limit(SAMPLE_TEXTS).toArrow()["text"].to_pylist()
    own = Counter(w for t in sample for w in set(_tokens(t)))
    rank = lambda x: sorted(x, key=lambda w: (-lexicon(w), w))
    words = rank(w for w in own if len(w) >= SHORTEST_WORD and w.isalpha() and not any(c in LIGATURES for c in w))
    words = sorted(words[: max(1, len(words) // 2)], key=lambda w: xxhash.xxh64_intdigest(w))[:TRAIN_WORDS] if words else []
    known = Editor()
    signs = rank(w for w in own if len(w) >= SHORTEST_WORD and not w.isalpha() and LETTER.search(w) and not DIGIT_INSIDE.search(w) and not any(n for edits, _, n in known.readings(w, lexicon) if edits))[:TRAIN_WORDS]
    known = set(words)
    compounds = sorted({(a, b) for t in sample for a, b in OWN_HYPHEN.findall(t.lower()) if a in known and b in known})[:TRAIN_WORDS]
    order = F.xxhash64("document_id")
    chosen = pages.filter("document_id is not null and text is not null and page is not null").select(order.alias("h"), "document_id", "page", F.substring("text", 1, 20000).alias("text"))
    docs: dict[str, dict[int, str]] = {}
    for r in chosen.orderBy("h", "document_id", "page").limit(SAMPLE_PAGES).toArrow().to_pylist():
        docs.setdefault(r["document_id"], {})[r["page"]] = r["text"]
    documents = [[t for _, t in sorted(x.items())][:50] for x in docs.values()]
    rng = random.Random(3)
    while len(documents) < 60:  # a small table is made up for
        documents.append([". ".join(" ".join(rng.choice(words or ["wall"]) for _ in range(8)) + "\n" for _ in range(6)) for _ in range(rng.randint(3, 12))])
    return Editor.train(words, lexicon, signs, compounds), Furniture.train(documents, words), cells


def _records(pages: DataFrame, review: DataFrame) -> DataFrame:
    """(table_name, record_key, document_id, text) of both tables; rows without text or key have no noise."""
    p = pages.select(F.lit("page_extractions").alias("table_name"), F.concat_ws("#", "document_id", F.when(F.col("page").isNotNull(), F.col("page").cast("string"))).alias("record_key"), "document_id", "text").filter("document_id is not null and page is not null")
    q = review.select(F.lit("needs_review").alias("table_name"), F.col("question_id").alias("record_key"), F.btrim("document_id").alias("document_id"), F.col("question_text").alias("text")).filter("question_id is not null")
    return p.unionByName(q).filter("text is not null and text <> ''")


def scan_noise(pages: DataFrame, review: DataFrame, scratch: Scratch) -> DataFrame:
    """(table_name, record_key, noise_kind), distinct. Null and empty texts have no noise; a page or question
    delivered twice is reported once; further columns play no part."""
    records = _records(pages, review)
    editor, model, cells = fit_models(records.select("text"), pages)
    shared = pages.sparkSession.sparkContext.broadcast((editor, model, cells.astype(np.int32)))
    furniture_model = pages.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, model, cells = shared.value
        reader = Reader(editor, Lexicon(cells))
        for b in batches:
            kinds = []
            for table, text in zip(b.column("table_name").to_pylist(), b.column("text").to_pylist()):
                lines, found = _lines(text), []
                page = table == "page_extractions"
                if any(model.is_number(s, i, len(lines), page) for i, s in enumerate(lines)):
                    found.append("pageno")
                misread, broken = reader.judge(text)
                if misread >= MISREAD_WORDS:
                    found.append("chars")
                if broken:
                    found.append("hyphen")
                kinds.append(found)
            yield pa.RecordBatch.from_pydict({"table_name": b.column("table_name"), "record_key": b.column("record_key"), "kinds": pa.array(kinds, pa.list_(pa.string()))})

    def furniture(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = []
            for head, text in zip(b.column("head").to_pylist(), b.column("text").to_pylist()):
                found = []
                keys = list(map(line_key, _lines(text)))
                if len(head) >= HEADER_LETTERS and head in fold(text) or any(key == head for key, _ in keys):
                    found.append("header")
                    if any(beside and key == head for key, beside in keys):
                        found.append("pageno")
                kinds.append(found)
            yield pa.RecordBatch.from_pydict({"table_name": b.column("table_name"), "record_key": b.column("record_key"), "kinds": pa.array(kinds, pa.list_(pa.string()))})

    schema = "table_name string, record_key string, kinds array<string>"
    heads = scratch.cut(header_keys(pages, furniture_model, scratch), "headers").select(F.lower("document_id").alias("d"), "head").distinct()
    local = records.select("table_name", "record_key", "text").mapInArrow(judge, schema)
    own = salted_join(records.withColumn("d", F.lower("document_id")), heads, "d", hot=hot_keys(pages.select(F.lower("document_id").alias("d")), "d"))
    seen = local.unionByName(own.select("table_name", "record_key", "text", "head").mapInArrow(furniture, schema))
    return seen.select("table_name", "record_key", F.explode("kinds").alias("noise_kind")).distinct()


def repair_text(text: str | None, headers: dict[str, str], reader: Reader, model: Furniture, page: bool = True) -> str | None:
    """Continuous paragraphs: furniture out, on lines of its own and inside lines, broken words joined, misread words as printed, lines of a paragraph joined."""
    if not text:
        return text
    rows = text.split("\n")
    filled = [i for i, s in enumerate(rows) if s.strip()]
    place = {i: k for k, i in enumerate(filled)}
    kept = []
    for i, s in enumerate(rows):
        if i in place and (model.is_number(s, place[i], len(filled), page) or headers and line_key(s)[0] in headers):
            continue
        kept.append(s.strip())
    whole = fold(text) if headers else ""
    headers = {h: sides for h, sides in headers.items() if len(h) >= HEADER_LETTERS and h in whole}
    joined = "\n".join(kept)
    out = reader.join(cut_headers(joined, headers) if headers else joined)

    paragraphs: list[str] = []
    for s in _plain(TOKEN.sub(lambda m: reader.printed[m[0]], out)).split("\n"):
        if not s or not paragraphs or not paragraphs[-1] or LABEL.match(s):
            paragraphs.append(s)
        else:
            paragraphs[-1] += " " + s
    return "\n".join(p for p in paragraphs if p)


def repaired_texts(pages: DataFrame, review: DataFrame, scratch: Scratch) -> DataFrame:
    """(table_name, record_key, repaired_text): every text of both tables as continuous readable paragraphs."""
    records = _records(pages, review)
    editor, model, cells = fit_models(records.select("text"), pages)
    shared = pages.sparkSession.sparkContext.broadcast((editor, model, cells.astype(np.int32)))
    furniture_model = pages.sparkSession.sparkContext.broadcast(model)
    heads = scratch.cut(header_keys(pages, furniture_model, scratch), "headers").groupBy(F.lower("document_id").alias("d")).agg(F.collect_set(F.struct("head", "sides")).alias("heads"))
    rows = salted_join(records.withColumn("d", F.lower("document_id")), heads, "d", "left", hot=hot_keys(pages.select(F.lower("document_id").alias("d")), "d"))

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, model, cells = shared.value
        reader = Reader(editor, Lexicon(cells))
        for b in batches:
            done = [repair_text(t, {x["head"]: x["sides"] for x in h or ()}, reader, model, n == "page_extractions") for t, h, n in zip(b.column("text").to_pylist(), b.column("heads").to_pylist(), b.column("table_name").to_pylist())]
            yield pa.RecordBatch.from_pydict({"table_name": b.column("table_name"), "record_key": b.column("record_key"), "repaired_text": pa.array(done, pa.string())})

    return rows.select("table_name", "record_key", "text", "heads").mapInArrow(fix, "table_name string, record_key string, repaired_text string").distinct()

