"""Problem 10: pages of keywords, tags, product entries, menus and links.

Each page's suffix automaton, over its words, marks and line ends, gives for every place the longest string
ending there that occurs elsewhere in the page; the letters and digits under such strings are its repeated
coverage. A page is cut into units (lines and sentences). A unit is spam where clause structure is missing,
that is, where it has next to no function words, and repeated coverage takes its place. Function words are
those that a large share of a language's documents have, counted over the whole corpus. Markup, links and
cells are read only to tell clauses: neither they nor lists make spam of what is said once. A page is spam
if more than half of its words lie in such units.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.arrow import WORD

#: Some function words of languages, lower-cased; what is known before the corpus is counted.
LANGUAGES = {
    "en": "a an and are as at by during for from in into is it of on one or that the to when while with each which what following",
    "fr": "a au aux ce cet cette chaque de des du d en est et l la le les où par plus pour qui sous sur un une vers à après dès près",
    "es": "al cada como con del de desde el en es esta este hasta la las los más no para por que se según sin sobre su tras un una y a",
    "de": "an aus bei beim das dem den der des die ein eine einem einen einer im in ist jede jeder jedes mit nach neben sich über und unter von vor während zu zum zur",
    "ar": "في من على عند بعد عن إلى الى و أو ثم لا ما هذا هذه ذلك التي الذي كل أن إن مع بين قبل تحت فوق خلال هو هي كما",
}
#: Share of a language's documents that have a function word, and the documents that are added to each language.
COMMON, PRIOR = 0.4, 200


def function_words(found: dict[str, set[str]] | None = None) -> dict[str, int]:
    """Bit of every language that has the word; without counts those of LANGUAGES."""
    found = {k: set(v.split()) for k, v in LANGUAGES.items()} if found is None else found
    return {w: sum(1 << k for k, lang in enumerate(sorted(found)) if w in found[lang]) for words in found.values() for w in words}


FUNCTION_WORDS = function_words()

TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
#: Units end at line ends and after sentence marks.
UNIT = re.compile(r"\n|(?<=[.!?؟])\s")
MARKUP = re.compile(r"<[a-z!/][^<>\n]*>", re.I)
LINK = re.compile(r"https?://\S+|\b[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}/\S*", re.I)
#: An answer key entry, an option or a numbered stem.
KEY = re.compile(r"\b\d{1,3}\s*[-.:)]\s*[a-h]\b", re.I)
LABEL = re.compile(r"\s*(?:[a-h]|\d{1,3})\s*[-.)·:]", re.I)
#: Share of a unit's letters and digits under repeated strings from which a unit without clauses is spam.
COVERED = 0.15
#: Places within which a string of two counts as repeated; further apart, two words meet again by chance.
NEAR = 1000
#: Share of function words that a clause has; more are needed beside a link. Words of a cell that holds no clause.
CLAUSE, BESIDE_LINK, CELL = 0.1, 0.15, 6


def repeated(tokens: list[str]) -> list[int]:
    """For every place, the length of the longest string of tokens that ends there and occurs elsewhere too.

    The automaton's state of each prefix is kept; a prefix that itself occurs again has a suffix-link
    child, any other's longest repeated suffix is its link's.
    """
    nxt: list[dict[str, int]] = [{}]
    link, size = [-1], [0]
    last, prefix = 0, []
    for t in tokens:
        cur = len(size)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and t not in nxt[p]:
            nxt[p][t] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][t]
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                clone = len(size)
                nxt.append(nxt[q].copy())
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(t) == q:
                    nxt[p][t] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
        prefix.append(cur)
    parents = set(link)
    return [size[s] if s in parents else size[link[s]] for s in prefix]


def common_words(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> dict[str, set[str]]:
    """Function words by language: those that COMMON of its documents have, over all documents.

    Every language counts PRIOR more documents, with the words of LANGUAGES or with none: that matters to
    languages of few documents only. A null language is one of its own. What reaches the driver is bounded: no language has more such
    words than its documents' mean number of different words, divided by COMMON.
    """
    lang = F.coalesce(F.lower(F.col(lang_col)), F.lit("")) if lang_col else F.lit("")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[str, str]] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in seen], pa.string()), "word": pa.array([k[1] for k in seen], pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return out

        for b in batches:
            for k, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                seen[k, ""] += 1  # the documents themselves
                seen.update((k, w) for w in set(WORD.findall(t.lower())))
            if len(seen) > 300_000:
                yield flush()
        yield flush()

    prior = [(k, w, PRIOR if w else 0) for k, v in LANGUAGES.items() for w in ["", *v.split()]]
    rows = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).filter("text is not null").mapInArrow(count, "lang string, word string, n bigint")
    sums = rows.unionByName(docs.sparkSession.createDataFrame(prior, "lang string, word string, n bigint")).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    totals = sums.filter("word = ''").select("lang", F.col("n").alias("docs"))
    found: dict[str, set[str]] = {}
    for r in sums.filter("word <> ''").join(totals, "lang").filter(F.col("n") >= F.lit(COMMON) * (F.col("docs") + PRIOR)).select("lang", "word").toLocalIterator():
        found.setdefault(r["lang"], set()).add(r["word"])
    return found


def page_measures(text: str | None, known: dict[str, int] = FUNCTION_WORDS) -> tuple[int, int, float]:
    """(words, words in spam units, share of letters and digits in units without clauses under repeated strings).

    A page all of whose units have clauses holds no spam whatever it repeats; its automaton would decide
    nothing and is left out.
    """
    if not text:
        return 0, 0, 0.0
    total = spam = 0
    units = UNIT.split(text.lower())
    open_units: list[tuple[int, int]] = []
    for k, unit in enumerate(units):
        words = WORD.findall(unit)
        if not words:
            continue
        total += len(words)
        if not _is_content(unit, words, known):
            open_units.append((k, len(words)))
    if not open_units:
        return total, 0, 0.0
    pieces = [[*TOKEN.findall(unit), "\n"] for unit in units]
    flat = [t for piece in pieces for t in piece]
    length = repeated(flat)
    if len(flat) > NEAR:
        near = _near_pairs(flat)
        length = [0 if n == 2 and i not in near else n for i, n in enumerate(length)]
    covered = [False] * len(flat)
    reach = len(flat)
    for i in range(len(flat) - 1, -1, -1):  # from the end: a place is covered by the earliest begin seen so far
        if length[i] >= 2:
            reach = min(reach, i - length[i] + 1)
        covered[i] = reach <= i
    size = [len(t) if t[0].isalnum() else 0 for t in flat]
    begin = [0]
    for piece in pieces:
        begin.append(begin[-1] + len(piece))
    under = 0
    for k, words in open_units:
        places = range(begin[k], begin[k + 1])
        hit = sum(size[i] for i in places if covered[i])
        under += hit
        if hit >= COVERED * sum(size[i] for i in places):
            spam += words
    return total, spam, under / sum(size)


def _near_pairs(tokens: list[str]) -> set[int]:
    """Places where two tokens end that occur again within NEAR places, before or after."""
    last: dict[tuple[str, str], int] = {}
    out: set[int] = set()
    for i, pair in enumerate(zip(tokens, tokens[1:]), 1):
        if i - last.get(pair, -NEAR - 1) <= NEAR:
            out |= {i, last[pair]}
        last[pair] = i
    return out


def _is_content(unit: str, words: list[str], known: dict[str, int]) -> bool:
    """Whether the unit has clause structure or is an answer key entry, an option, numbers or a numbered stem.

    Markup and a link have no words of a clause, nor has a short cell of a row with two or more bars.
    """
    least = CLAUSE
    if "<" in unit:
        bare = MARKUP.sub(" ", unit)
        if bare != unit:
            unit, words = bare, WORD.findall(bare)
    if "/" in unit and LINK.search(unit):
        words, least = WORD.findall(LINK.sub(" ", unit)), BESIDE_LINK
    elif unit.count("|") >= 2:
        words = [w for cell in map(WORD.findall, unit.split("|")) if len(cell) > CELL for w in cell]
    elif words and (LABEL.match(unit) or all(len(w) < 2 or w.isdecimal() for w in words) or len(KEY.findall(unit)) * 2 >= 0.7 * len(words)):
        return True
    return bool(words) and _clause_words(words, known) >= least * len(words)


def _clause_words(words: list[str], known: dict[str, int]) -> int:
    """Function words of the language that has most of them here."""
    bits = [n for n in map(known.get, words) if n]
    if not bits:
        return 0
    kinds = Counter(bits)
    every = 0
    for n in kinds:
        every |= n
    return max(sum(c for n, c in kinds.items() if n >> k & 1) for k in range(every.bit_length()))


def spam_pages(docs: DataFrame, doc_id: str = "doc_id", share: float = 0.5) -> DataFrame:
    """(doc_id, words, spam_words, coverage, is_spam), one row per input row.

    A null or wordless text has zero words and is no spam. Every text is measured whole. Without a column
    lang all documents count as one language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(function_words(common_words(docs, lang_col="lang" if "lang" in docs.columns else None)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [page_measures(t, shared.value) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                doc_id: b.column("d"), "words": pa.array([r[0] for r in rows], pa.int32()), "spam_words": pa.array([r[1] for r in rows], pa.int32()),
                "coverage": pa.array([r[2] for r in rows], pa.float64()), "is_spam": pa.array([r[1] > share * r[0] for r in rows], pa.bool_()),
            })

    return docs.select(F.col(doc_id).alias("d"), "text").mapInArrow(measure, f"{doc_id} {dict(docs.dtypes)[doc_id]}, words int, spam_words int, coverage double, is_spam boolean")
