"""Problem 7: text decoded with the wrong character encoding.

Characters are mapped back to the bytes of a legacy encoding; a byte-structure automaton for UTF-8 finds
the maximal well-formed multibyte spans, and only those spans are decoded. Text decoded several times is
undone as often. Single-byte text read in another single-byte encoding has no such structure: one-byte Arabic
is told by runs of accented letters, as no right word has them; Western text by the corpus, whose words must
be more often what the other encoding makes of the page's words than what stands there.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings that UTF-8 is wrongly read in, and of each the characters that may lead a span.
#: None: all of them. Elsewhere some leads are ordinary punctuation or symbols, so only the others count.
CODECS: dict[str, str | None] = {"cp1252": None, "cp1251": None, "mac_roman": "√¬ƒ≈∆ÿŸ‚", "cp437": "┬├─┼╞╟╪┘ΓπΣ", "cp850": "┬├─┼╬Ï┘Ô", "cp1250": None, "koi8_r": None}

#: The automaton: well-formed UTF-8 sequences of two to four bytes, one or more of them.
SPAN = re.compile("(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+")
#: Blocks of scripts in wide use and of signs; a decoded span holds only these. Syriac to Mandaic, which
#: a final ß, Ü or Ý before a soft hyphen or a quotation mark would make, are left out.
BLOCKS = (
    (0x80, 0x2AF), (0x2B0, 0x52F), (0x531, 0x58F), (0x591, 0x5FF), (0x600, 0x6FF), (0x900, 0xDFF), (0xE00, 0xFFF), (0x10A0, 0x11FF), (0x1E00, 0x1FFF), (0x2010, 0x2BFF), (0x3000, 0x9FFF),
    (0xAC00, 0xD7AF), (0xFB00, 0xFB4F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF), (0xFF00, 0xFFEF), (0x1F000, 0x1FAFF), (0x20000, 0x2FA1F),
)
#: Encodings in which the leads are letters of running text: spans must hold most of them.
CYRILLIC = ("cp1251", "koi8_r")
#: A bare lead of a sequence whose second byte became a blank.
CUT = re.compile("Ã(?=[\\s.,;:?!)]|$)|Â(?=[°±µ«»§©®·])")
#: Arabic in one byte per letter (cp1256) read as cp1252.
RUN = re.compile("[À-ÿŒœŠšŸŽžƒªº]{3,}")
#: A letter of another alphabet between two Latin ones, as no alphabet is mixed.
FOREIGN = re.compile("(?<=[a-z])[Ѐ-џ](?=[a-z])")
#: One-byte encodings that Western text (cp1252) may have been read in.
SINGLE = ("cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "iso8859_2")
#: Cells of each of the two rows of word counts, whatever the corpus.
CELL_BITS = 20
#: How much more often a word must occur than what stands there to be the right one.
OFTENER = 2
ACCENTED = re.compile(r"[^\W\d_]*[^\x00-\x7f\W\d_][^\W\d_]*")


def _back(codec: str) -> dict[int, str]:
    """Translation of characters to bytes (as Latin-1 characters); bytes a codec leaves undefined stay C1 controls."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            table[ord(bytes([b]).decode(codec))] = chr(b)
        except UnicodeDecodeError:
            pass
    if codec in ("cp1252", "cp1250", "cp1251"):
        for b in range(0x80, 0xA0):
            table.setdefault(b, chr(b))
    return table


class _Back(dict):
    """For str.translate: what the codec has no byte for becomes a character no span holds."""

    def __missing__(self, c: int) -> str:
        return chr(c) if c < 0x80 else "￿"


BACK = {codec: _Back(_back(codec)) for codec in CODECS}


def _begins(codec: str) -> re.Pattern:
    """A lead and a continuation next to each other, as the codec shows them."""
    leads = "".join(re.escape(chr(c)) for c, b in BACK[codec].items() if "\xc2" <= b <= "\xf4" and (CODECS[codec] is None or chr(c) in CODECS[codec]))
    rest = "".join(re.escape(chr(c)) for c, b in BACK[codec].items() if "\x80" <= b <= "\xbf")
    return re.compile(f"[{leads}][{rest}]")


BEGINS = {codec: _begins(codec) for codec in CODECS}
#: Anything that could begin structural evidence.
SUSPECT = re.compile("|".join(x.pattern for x in (*BEGINS.values(), RUN, CUT, FOREIGN)) + "|�")


def _western(codec: str) -> dict[int, str]:
    """The letters that only this encoding reads a byte as, and the letter that cp1252 reads it as."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            read, right = bytes([b]).decode(codec), bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            continue
        if read != right and read.isalpha() and right.isalpha():
            table[ord(read)] = right
    return table


WESTERN = {c: _western(c) for c in SINGLE}
#: Letters that Western text has only if read wrongly, or that belong to another language.
ODD = re.compile("[" + "".join(sorted({chr(c) for t in WESTERN.values() for c in t if not (0xC0 <= c <= 0xFF)})) + "]")


@dataclass
class Repair:
    text: str
    spans: int
    codecs: tuple[str, ...]
    lost: int

    @property
    def garbled(self) -> bool:
        return bool(self.spans or self.lost)


def _plausible(span: str) -> list[tuple[int, int, str]]:
    """(begin, end, decoded) of the maximal parts of a span that decode to assigned characters of BLOCKS."""
    out: list[tuple[int, int, str]] = []
    at = 0
    for c in span.encode("latin-1").decode("utf-8"):
        n = len(c.encode("utf-8"))
        if any(lo <= ord(c) <= hi for lo, hi in BLOCKS) and (c < "\xa0" or unicodedata.category(c)[0] != "C" or c in "\xad\ufeff"):  # C1: a wrongly decoded byte once more
            if out and out[-1][1] == at:
                out[-1] = (out[-1][0], at + n, out[-1][2] + c)
            else:
                out.append((at, at + n, c))
        at += n
    return [x for x in out if len(x[2]) > 1 or not 0x3000 <= ord(x[2]) < 0xFB00]  # one sign of East Asia alone is chance


def _decode_spans(text: str, codec: str) -> tuple[str, int, int]:
    """(text with the codec's spans decoded, their number, the characters they were)."""
    if not BEGINS[codec].search(text):
        return text, 0, 0
    leads = CODECS[codec]
    as_bytes = text.translate(BACK[codec])
    out, at, count, size = [], 0, 0, 0
    for m in SPAN.finditer(as_bytes):
        if leads and not all(text[k] in leads for k in range(m.start(), m.end()) if as_bytes[k] >= "\xc2"):
            continue
        for begin, end, fixed in _plausible(m.group()):
            out += [text[at : m.start() + begin], fixed]
            at, count, size = m.start() + end, count + 1, size + end - begin
    if codec in CYRILLIC and count:
        every = sum("\xc2" <= c <= "\xf4" for c in as_bytes)
        inside = sum("\xc2" <= c <= "\xf4" for m in SPAN.finditer(as_bytes) for c in m.group())
        if 2 * inside <= every:
            return text, 0, 0
    return ("".join(out) + text[at:], count, size) if count else (text, 0, 0)


def repair(text: str | None, lexicon: Callable[[str], int] | None = None) -> Repair:
    """The text with wrong decodings undone where that can be done; lost counts what can't be restored.

    lexicon: how often the corpus has a word; without it Western text read in another one-byte encoding stays.
    """
    if not text or text.isascii():
        return Repair(text or "", 0, (), 0)
    spans, lost, used = 0, 0, []
    if SUSPECT.search(text):
        while True:  # a text can be wrongly decoded any number of times; each pass leaves fewer characters to explain
            tried = [(*_decode_spans(text, c), c) for c in CODECS] + [(*_decode_arabic(text), "cp1256")]
            fixed, n, size, codec = max(tried, key=lambda x: x[2])  # the encoding that explains the most characters
            if not n:
                break
            text, spans = fixed, spans + n
            used.append(codec)
    if lexicon and ODD.search(text):
        tried = [(*_decode_western(text, c, lexicon), c) for c in SINGLE]
        fixed, n, codec = max(tried, key=lambda x: x[1])
        if n:
            text, spans = fixed, spans + n
            used.append(codec)
    lost = text.count("�") + len(CUT.findall(text)) + len(FOREIGN.findall(text))
    return Repair(text, spans, tuple(dict.fromkeys(used)), lost)


def _decode_western(text: str, codec: str, lexicon: Callable[[str], int]) -> tuple[str, int]:
    """(text with Western words restored, their number). A word is better read otherwise if the corpus has that
    reading OFTENER times as often, worse if it is the other way round; words that the corpus tells nothing of go
    with the page if more of its words are better than worse."""
    table, judged = WESTERN[codec], {}
    for w in set(ACCENTED.findall(text)):
        made = w.translate(table)
        if made != w:
            here, there = lexicon(w.lower()), lexicon(made.lower())
            judged[w] = (made, 1 if there > OFTENER * here else -1 if here > OFTENER * there else 0)
    better = sum(v > 0 for _, v in judged.values())
    worse = sum(v < 0 for _, v in judged.values())
    if not better or better <= worse:
        return text, 0
    count = 0

    def fix(m: re.Match) -> str:
        nonlocal count
        made, v = judged.get(m.group(), (None, -1))
        if v < 0:
            return m.group()
        count += 1
        return made

    return ACCENTED.sub(fix, text), count


def word_counts(pages: DataFrame) -> np.ndarray:
    """Both rows of cells with the counts of all words of the column text that hold other than ASCII letters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 << CELL_BITS, np.int64)
        seen: Counter[str] = Counter()

        def flush() -> None:
            h = np.array([xxhash.xxh64_intdigest(w) for w in seen], np.uint64)
            n = np.array(list(seen.values()), np.int64)
            mask = np.uint64((1 << CELL_BITS) - 1)
            np.add.at(sums, (h & mask).astype(np.int64), n)
            np.add.at(sums, ((h >> np.uint64(32)) & mask).astype(np.int64) + (1 << CELL_BITS), n)
            seen.clear()

        for b in batches:
            for t in b.column("text").to_pylist():
                if t and not t.isascii():
                    seen.update(ACCENTED.findall(t.lower()))
            if len(seen) > 300_000:
                flush()
        if seen:
            flush()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(at.astype(np.int32)), "n": pa.array(sums[at])})

    got = pages.select("text").mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(2 << CELL_BITS, np.int64)
    cells[got["cell"].to_numpy()] = got["n"].to_numpy()
    return cells.reshape(2, -1)


class Counts:
    """A word's count, bounded from above by the smaller of its two cells."""

    def __init__(self, cells: np.ndarray):
        self.cells, self.mask = cells, cells.shape[1] - 1

    def __call__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word)
        return min(int(self.cells[0][h & self.mask]), int(self.cells[1][(h >> 32) & self.mask]))


def _decode_arabic(text: str) -> tuple[str, int, int]:
    """One-byte Arabic read as cp1252; only where some run of letters could be nothing else. As _decode_spans."""
    sure = [m.group() for m in RUN.finditer(text) if _try_arabic(m.group())]
    if not sure:
        return text, 0, 0
    count = 0

    def fix(m: re.Match) -> str:
        nonlocal count
        fixed = _try_arabic(m.group())
        count += bool(fixed)
        return fixed or m.group()

    return re.sub("[¡-ÿŒœŠšŸŽžƒˆ‘-„†-•…‰‹›€™]+", fix, text), count, sum(map(len, sure))


def _try_arabic(run: str) -> str:
    try:
        fixed = run.encode("cp1252").decode("cp1256")
    except UnicodeError:
        return ""
    return fixed if all("؀" <= c <= "ۿ" for c in fixed) else ""


def repair_pages(pages: DataFrame, keys: tuple[str, ...] = ("document_id", "page")) -> DataFrame:
    """keys + (garbled, restored_text, spans, lost, codecs), one row per input row.

    restored_text is the text itself where nothing was wrong, null for null. The text column must be named
    text; further columns play no part.
    """
    kinds = dict(pages.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", garbled boolean, restored_text string, spans int, lost int, codecs array<string>"

    shared = pages.sparkSession.sparkContext.broadcast(word_counts(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(shared.value)
        for b in batches:
            texts = b.column("text").to_pylist()
            done = [repair(t, counts) for t in texts]
            cols = {k: b.column(k) for k in keys}
            yield pa.RecordBatch.from_pydict(cols | {
                "garbled": pa.array([r.garbled for r in done], pa.bool_()), "restored_text": pa.array([None if t is None else r.text for t, r in zip(texts, done)], pa.string()),
                "spans": pa.array([r.spans for r in done], pa.int32()), "lost": pa.array([r.lost for r in done], pa.int32()), "codecs": pa.array([list(r.codecs) for r in done], pa.list_(pa.string())),
            })

    return pages.select(*keys, "text").mapInArrow(run, schema)


def garbled_keys(pages: DataFrame) -> DataFrame:
    """(document_id, page) of every page with a wrongly decoded passage, distinct."""
    found = repair_pages(pages).filter(F.col("garbled") & F.col("document_id").isNotNull() & F.col("page").isNotNull())
    return found.select("document_id", "page").distinct()
