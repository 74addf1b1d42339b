"""Personal data in texts, also where it is disguised, with spans in the text as given.

Two passes. The base pass finds plain identifiers in the text itself. The second
runs the text through transducers that emit normalised characters together with
the source span of each: character references are resolved, homoglyphs, full-width forms,
dashes, spaces and digits of other scripts become ASCII, invisible characters vanish,
spelled digits become digits, and at/dot disguises become `@` and `.`. Identifiers found there are mapped back to source characters and added
unless a base span of their kind holds them whole: of a disguise in one part of an
identifier, the base pattern may have found the rest. Nothing in a base span ever changes.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.arrays import slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# Each pattern starts at the head of a run that a match would have to contain whole, and
# its runs never give characters back where that cannot help, so long texts stay linear.
_LOCAL = "A-Za-z0-9._%+-"
_EMAIL = re.compile(rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EMAIL_HEAD = re.compile(rf"(?<![{_LOCAL}])[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while at <= len(text):
        # Right after a match a new one may start in the middle of a run.
        m = (_EMAIL.match(text, at) if at else None) or _EMAIL_HEAD.search(text, at)
        if m is None:
            return
        yield m.span()
        at = m.end()


def plain(text: str) -> list[Span]:
    """Base identifiers, leftmost and non-overlapping per kind; a failing match is dropped."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    found = [m for m in _IP.finditer(text)]
    out += [("ip", *m.span()) for m in found if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in m[0].split("."))]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


# Letters of other scripts that look like ASCII ones.
LOOKALIKES = """
Cyrillic: АA ВB ЕE КK МM НH ОO РP СC ТT ХX ЅS ІI ЈJ ҮY ԌG ԚQ ԜW ѴV Ԁd Ӏl ЬB ЗE
Cyrillic: аa вb еe кk мm нh оo рp сc тt хx уy ѕs іi јj үy ԛq ԝw ѵv ԁd ӏl ьb һh пn гr
Greek: ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ͿJ
Greek: οo αa νv ρp τt υu ιi χx κk γy σo ηn ωw εe ϳj
Armenian: ՍU ՏS ՕO ԼL ցg հh ոn ռn օo սu զq յj ԝw
Cherokee: ᎠD ᎡR ᎢT ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᏀG ᏃZ ᏙV ᏚS ᏞL ᏟC ᏢP ᏦK ᏴB
Latin: ɑa ɡg ıi ɩi ʋv
Signs: −- ⁄/ 。. ․.
"""
HOMOGLYPHS = {pair[0]: pair[1] for pair in LOOKALIKES.split() if len(pair) == 2}
# Spelled digits.
DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_SPELLED = "|".join([*DIGIT_WORDS, "oh"])
_AT = r"[\[({<]\s*at\s*[\])}>]"
_DOT = r"[\[({<]\s*(?:dot|\.)\s*[\])}>]"
# What makes the second pass worth its time; anything it could change matches here. One
# alternative per rewrite: references, brackets, a bare dot, a bare `at` before either or
# before a domain, two spelled digits, one beside a digit or dot as in `_beside_digit`, plus before a digit, lookalikes.
_TRIGGER = re.compile(
    rf"(?i)&\#?[a-z0-9]{{1,32}};|\bat\s+[a-z0-9-]+\.[a-z0-9]|[\[({{<]\s*(?:at|dot|@|\.)\s*[\])}}>]|\bdot\b|(?:\b(?:{_SPELLED})\b[\s,.-]*+){{2}}|"
    rf"[0-9.][ -]?\n?\b(?:{_SPELLED})\b|\b(?:{_SPELLED})\b[ -]?[0-9.]|"
    rf"\bplus\s+(?:[0-9]|(?:{_SPELLED})\b)|[0-9][oOlI|]|[oOlI|][0-9]"
)
_DISGUISED_AT = re.compile(rf"(?i)(?:(?<!\s)\s++)?(?:{_AT}|[\[({{<]\s*@\s*[\])}}>])\s*")
_DISGUISED_DOT = re.compile(rf"(?i)(?:(?<!\s)\s++)?{_DOT}\s*|(?<=[a-z0-9])\s+dot\s+(?=[a-z0-9])")
# A bare word `at` counts only between a word and a label that a disguised dot follows.
_BARE_AT = re.compile(rf"(?i)(?<=[a-z0-9])\s+at\s+(?=[a-z0-9-]+(?:\s*{_DOT}\s*|\s+dot\s+)[a-z0-9-]+)")
# Before a plain domain a bare `at` counts where the word before it can only be a local part:
# it holds a mark or digit, follows a cue or colon, or the line holds nothing else.
_CUE = r"\b(?:e-?mail|mail|contact|write|reach|address)(?:ed|ing)?\b(?:\s+(?:is|to|me|us|at))*+(?:\s*+:)?\s*+|[:<(]\s*+"
# Words that stand before `at` in plain prose.
_PROSE = "look looking see seen visit find found is are was be us me it them here there now only online available more and or not out up"
_AT_DOMAIN = re.compile(
    rf"(?im)(?:(?P<cue>{_CUE})|(?P<line>^[ \t]*+))?(?<![{_LOCAL}])(?P<local>[a-z0-9][{_LOCAL}]*+)"
    r"(?P<at>\s+at\s+)(?=[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,24}(?![a-z0-9-]|\.[a-z0-9])(?P<alone>[ .,;!?)>]*$)?)"
)
_REFERENCE = re.compile(r"(?i)&\#?[a-z0-9]{1,32};")
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")
_SPELLED_RUN = re.compile(rf"(?i)\b(?:{_SPELLED})\b(?:[\s,-]+(?:{_SPELLED})\b)*")
#: A run that also goes on after a full stop; taken whole only where its digits then fit.
_SPELLED_LONG = re.compile(rf"(?i)(?P<plus>\bplus\s+|\+\s*)?\b(?:{_SPELLED})\b(?:[\s,.-]+(?:{_SPELLED})\b)*")
_SPELLED_WORD = re.compile(rf"(?i)\b(?:{_SPELLED})\b")
_LOOKALIKE_RUN = re.compile(r"[0-9oOlI|]*[0-9][0-9oOlI|]*")
_PLUS_WORD = re.compile(rf"(?i)\bplus\s+(?=[0-9]|(?:{_SPELLED})\b)")


class Transduced:
    """Normalised characters with the source span of each."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text), dtype=np.int64)
        self.end = self.start + 1

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans of the current text; the new characters share the span's source."""
        if not edits:
            return
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            starts.append(self.start[at:a])
            ends.append(self.end[at:a])
            if new:
                starts.append(np.full(len(new), self.start[a]))
                ends.append(np.full(len(new), self.end[b - 1]))
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.start = np.concatenate([*starts, self.start[at:]])
        self.end = np.concatenate([*ends, self.end[at:]])

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[a:b].max())


@lru_cache(maxsize=1 << 16)
def folded(c: str) -> str | None:
    """What stands for a character beyond ASCII; None where nothing does."""
    if c in HOMOGLYPHS:
        return HOMOGLYPHS[c]
    kind, name = unicodedata.category(c), unicodedata.name(c, "")
    if kind in ("Cf", "Zs", "Pd"):
        return {"Cf": "", "Zs": " ", "Pd": "-"}[kind]
    if kind == "Nd":
        return str(unicodedata.decimal(c))
    if re.fullmatch("LATIN LETTER SMALL CAPITAL [A-Z]", name):
        return name[-1].lower()
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and " " < form < "\x80" else None


def _references(t: Transduced) -> None:
    edits = []
    for m in _REFERENCE.finditer(t.text):
        char = html.unescape(m[0])
        if len(char) == 1:
            edits.append((*m.span(), char))
    t.rewrite(edits)


def _letters(t: Transduced) -> None:
    found = [(*m.span(), folded(m[0])) for m in _NOT_ASCII.finditer(t.text)]
    t.rewrite([edit for edit in found if edit[2] is not None])


def _spelled_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of spelled digits; one goes on after a full stop where that makes a card or phone number."""
    for long in _SPELLED_LONG.finditer(text):
        runs = [m.span() for m in _SPELLED_RUN.finditer(text, long.end("plus") if long["plus"] else long.start(), long.end())]
        if len(runs) > 1:
            digits = "".join(DIGIT_WORDS.get(w[0].lower(), "0") for w in _SPELLED_WORD.finditer(long[0]))
            if (16 <= len(digits) <= 19 and luhn(digits)) or (long["plus"] and 8 <= len(digits) <= 15):
                runs = [(runs[0][0], runs[-1][1])]
        yield from runs


def _numbers(t: Transduced) -> None:
    edits = []
    for start, end in _spelled_runs(t.text):
        words = list(_SPELLED_WORD.finditer(t.text, start, end))
        if len(words) > 1 or _beside_digit(t.text, start, end):
            for k, w in enumerate(words):
                # A run loses its separators, so that digits stand side by side.
                stop = words[k + 1].start() if k + 1 < len(words) else w.end()
                edits.append((w.start(), stop, DIGIT_WORDS.get(w[0].lower(), "0")))
    t.rewrite(edits)
    edits = []
    for m in _LOOKALIKE_RUN.finditer(t.text):
        run = m[0]
        joined = (m.start() and t.text[m.start() - 1].isalpha()) or (m.end() < len(t.text) and t.text[m.end()].isalpha())
        if not joined and 2 * sum(c.isdigit() for c in run) > len(run):
            edits += [(m.start() + k, m.start() + k + 1, "0" if c in "oO" else "1") for k, c in enumerate(run) if not c.isdigit()]
    t.rewrite(edits)
    t.rewrite([(*m.span(), "+") for m in _PLUS_WORD.finditer(t.text)])


def _beside_digit(text: str, a: int, b: int) -> bool:
    return bool(re.search(r"[0-9.][ -]?$", text[max(0, a - 2) : a]) or re.match(r"[ -]?[0-9.]", text[b : b + 2]))


def _marks(t: Transduced) -> None:
    t.rewrite([(*m.span(), "@") for m in _DISGUISED_AT.finditer(t.text)])
    t.rewrite([(*m.span(), "@") for m in _BARE_AT.finditer(t.text)])
    t.rewrite([(*m.span(), ".") for m in _DISGUISED_DOT.finditer(t.text)])
    t.rewrite([(*m.span("at"), "@") for m in _AT_DOMAIN.finditer(t.text) if _is_local(m)])


def _is_local(m: re.Match) -> bool:
    if m["local"].lower() in _PROSE.split():
        return False
    marked = re.search(r"[0-9]|[A-Za-z][._%+-][A-Za-z]", m["local"]) is not None
    return marked or m["cue"] is not None or (m["line"] is not None and m["alone"] is not None)


STEPS = (_references, _letters, _numbers, _marks)


def suspicious(text: str) -> bool:
    """Could a transducer change this text in a way that shows an identifier?"""
    if not text.isascii() and any(c >= "\x80" and folded(c) is not None for c in set(text)):
        return True
    return _TRIGGER.search(text) is not None


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Identifiers that the normalised text shows, as source spans that no base span of their kind holds."""
    t = Transduced(text)
    for step in STEPS:
        step(t)
    if t.text == text:
        return []
    taken = {kind: sorted((a, b) for k, a, b in base if k == kind) for kind in KINDS}
    out = []
    for kind, a, b in plain(t.text):
        start, end = t.source(a, b)
        # Base spans of a kind are disjoint: the last that starts before `end` is the last to touch.
        near = bisect_left(taken[kind], (end, 0))
        touched = near > 0 and taken[kind][near - 1][1] > start
        if kind == "email" and not touched and not re.search(r"\.[A-Za-z]{2,24}$", t.text[a:b]):
            continue
        holder = bisect_left(taken[kind], (start + 1, 0))
        if holder and taken[kind][holder - 1][1] >= end:
            continue
        out.append((kind, start, end))
    return out


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, by kind as listed and then by start."""
    base = plain(text)
    order = lambda s: (KINDS.index(s[0]), s[1], s[2])
    more = disguised(text, base) if suspicious(text) else []
    return sorted(base, key=order), sorted(base + more, key=order)


def _told(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, digest of the base spans and all spans of every row; offsets are code points.

    A null or empty text has no spans; repeated rows get equal results; an empty table
    gives no rows. Other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                counts = {k: [] for k in KINDS}
                digests, spans = [], []
                for text in pc.fill_null(piece.column("text"), "").to_pylist():
                    base, every = find(text)
                    for k in KINDS:
                        counts[k].append(sum(s[0] == k for s in every))
                    digests.append(hashlib.sha256(_told(base).encode()).hexdigest())
                    spans.append(_told(every))
                columns = [piece.column("doc_id"), *[pa.array(counts[k], pa.int64()) for k in KINDS]]
                columns += [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return chosen.mapInArrow(scan, f"doc_id long, {kinds}, base_sha256 string, spans string")
