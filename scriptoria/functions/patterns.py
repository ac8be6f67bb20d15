"""Patterns and word lists that decide what a line is. All match the whole line unless said otherwise."""

from __future__ import annotations

# What makes a line a section header, by kind of section.
SECTION_HEADERS = {
    "mcq": r"(?i)^m\.?\s*c\.?\s*q'?s?\.?$",
    "fill_in_blank": r"(?i)^fill\s+in\s+the\s+blanks?$",
    "matching": r"(?i)^(cross[\s-]*)?matching$",
    "answer_key": r"(?i)^model\s+answers?$",
}

# Numbered stem, option, matching stem (groups: number or label, rest).
STEM = r"(?U)^(?:[^\W\d_]{1,2}\s+)?(\d{1,3})\s*[-:.)]+\.?\s*(.*)$"
OPTION = "(?U)^([a-fA-F])\\s*[-.)·]\\s*(.*)$"
MATCHING_STEM = r"(?iU)^(\d{1,3})\s*[-.)]+\s*(match.*)$"

# Lines that carry no content.
PAGE_NUMBER = r"^\d{1,4}$"
PAGE_LABEL = r"(?i)^\d{1,4}\s*\|\s*p\s*a\s*g\s*e\.?$"
FENCE = r"(?U)^`{3,}\w*$"

# Entries of answer keys, found anywhere in a line.
KEY_TOKEN = r"(?i)(\d{1,3}|\bso\b)\s*[-.]\s*([a-e])\b"
GROUPED_KEY_TOKEN = r"(\d{1,3})\s*[-.]\s*([a-eA-E](?:\s*&\s*[a-eA-E])*)\b"
MATCHING_TOKEN = r"\((\d{1,3})\)|(\d{1,2})\s*[-.]+\s*([A-Za-z])\b"
KEY_LINE = r"^[\s|:\-.&a-eA-E0-9]+$"

# What describes a layout (key lines, inline answers, key headers, kinds of headers).
ANY_KEY_LINE = r"^[\s|:\-.&,a-fA-F0-9)(]+$"
ANY_KEY_TOKEN = r"(?U)(?<!\w)\d{1,3}\s*[-.):|]?\s*[a-fA-F](?:\s*[&,]\s*[a-fA-F])*(?!\w)"
INLINE_ANSWER = r"(?i)^(?:correct\s+answer|answer|ans|key)\s*[:.\-=)]*\s*\(?[a-f](?:\s*[&,]\s*[a-f])*\)?\.?\s*$"
KEY_HEADER = r"(?i)^(?:model\s+)?(?:answers?|answer\s+key|key|solutions?)(?:\s+sheet)?$"
ANY_HEADER = r"(?i)^(?:m\.?\s*c\.?\s*q'?s?|fill in the blanks?|(?:cross[\s-]*)?matching)$"
LEAD_MARK = r"(?i)^\(?\[?(?:q(?:uestion)?\s*)?[0-9a-h]{1,3}\s*[-.):·\]]+\s*"
MARK_ANYWHERE = r"(?i)[*✓✔]|\(correct\)"
MARKS = ("*", "✓", "✔", "(correct)")

# Candidate styles of stems (prefix, opening, closer) and options (case, opening, closer).
STEM_STYLES = [(p, o, c) for p in ("", "Q", "Question") for o, c in (("", "-"), ("", "."), ("", ")"), ("", ":"), ("(", ")"), ("[", "]"))]
STEM_PARTS = r"(?iU)^(?:(Question|Q)\s*)?(?:([(\[])\s*)?(\d{1,3})\s*([-.):\]])"
OPTION_PARTS = r"(?U)^(?:(\()\s*)?([a-fA-F])\s*([-.):])"
OPTION_STYLES = [(k, o, c) for k in ("lower", "upper") for o, c in (("", "."), ("", ")"), ("", "-"), ("", ":"), ("(", ")"))]

# Punctuation that is no noise, and the thresholds of the text gate in the order of its checks.
CLEAN_PUNCTUATION = ".,;:!?()[]{}'\"-_/\\%&+=<>*#@°ºµ±×÷√∞≈≠≤≥→←↔$€£¥|~^`"
REPLACEMENT_MOST, CONTROL_MOST, SAME_CHAR_MOST, NOISE_MOST = 0.01, 0.02, 0.4, 0.15

# Running lines (distinct pages, share of pages, characters at most).
FURNITURE_PAGES, FURNITURE_SHARE, FURNITURE_CHARS = 3, 0.3, 60

# Weights of the parts of a layout signature.
SIGNATURE_WEIGHTS = {"stem": 3.0, "opt": 2.0, "key_header": 1.5, "key_like": 1.5, "inline_ans": 1.0, "marked_opt": 1.0, "restarts": 1.0, "opts_per_stem": 1.0, "headings": 0.5}
