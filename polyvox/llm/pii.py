"""Operator 4: personal data with offset-preserving deobfuscation.

Base spans come from four fixed patterns on the text as it is. For disguised
identifiers the text is rewritten by small transducers - look-alike letters
and invisible characters, spelled digits, and at/dot disguises - each of
which also yields, for every character it writes, the source span it came
from. The same patterns run on the rewritten text and their matches are
mapped back to source characters. Base spans always stay; a disguised span
is added where it doesn't overlap a base span.

Offsets are code points, end exclusive. Each text is worked on whole.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MASKS = {k: f"<{k.upper()}>" for k in KINDS}

# The patterns of the contract, written so that each is linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

# Digits in words, by language.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
# Letters of other scripts that look like Latin ones.
_LOOKS = ("аa вb еe кk мm нh оo рp сc тt уy хx іi јj ѕs ԁd ɡg һh ԛq ԝw "
          "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS "
          "αa οo ρp νv ιi κk τt υu χx ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX")
LOOK_ALIKES = {p[0]: p[1] for p in _LOOKS.split()}
_HIDDEN = frozenset("­​‌‍⁠﻿")
# Other shapes of single signs.
_SIGNS = {"＠": "@", "﹫": "@", "．": ".", "。": ".", "․": ".", "‐": "-", "‑": "-",
          "‒": "-", "–": "-", "－": "-", "＋": "+", " ": " ", " ": " ", " ": " "}
_WORD_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?i)(?<!\w)(?:(?:plus|\+)[ -]*)?(?:{_WORD_DIGIT}|[0-9]+)"
                      rf"(?:[ ,.()-]{{1,4}}(?:{_WORD_DIGIT}|[0-9]+|dot|point|punkt|punto))++(?!\w)")
_ONE_DIGIT = re.compile(rf"(?i)(?<!\w)(?:{_WORD_DIGIT})(?!\w)")
_SPELLED_PART = re.compile(rf"(?i)({_WORD_DIGIT})|(plus|\+)|([0-9]+)|(dot|point|punkt|punto)")
_BRACKET_AT = re.compile(r"(?i)[ \t]{0,3}[\[({<]\s{0,3}(?:at|arroba|arobase|@)\s{0,3}[\])}>][ \t]{0,3}")
_BRACKET_DOT = re.compile(r"(?i)[ \t]{0,3}[\[({<]\s{0,3}(?:dot|punkt|point|punto|\.)\s{0,3}[\])}>][ \t]{0,3}")
_SPACED_AT = re.compile(r"(?i)[ \t]{1,3}(?:at|@|arroba|arobase)[ \t]{1,3}|[ \t]{1,3}@|@[ \t]{1,3}|_at_|-at-")
_SPACED_DOT = re.compile(r"(?i)[ \t]{1,3}(?:dot|punkt|\.)[ \t]{1,3}|_dot_|-dot-")
_CLEAR_AT = re.compile(r"(?i)[ \t]{1,3}(?:@|arroba|arobase)[ \t]{1,3}|[ \t]{1,3}@|@[ \t]{1,3}|_at_|-at-")
# "point" and "punto" are ordinary words too: dots only between numbers, in the name before an at, and in
# the domain after one. "At this point in ..." is English: after a bare "at", "point" needs a known ending.
_POINT = re.compile(r"(?i)[ \t]{1,3}(?:point|punto)[ \t]{1,3}")
_LABEL = r"[A-Za-z0-9-]{1,63}"
_NUMBER_POINT = re.compile(rf"(?<=[0-9]){_POINT.pattern[4:]}(?=[0-9])", re.I)
# the last "point" word before a name's part that ends where it is asked for
_LOCAL_POINT = re.compile(rf"(?<=[A-Za-z0-9_%+-])({_POINT.pattern[4:]})[A-Za-z0-9._%+-]{{1,64}}\Z", re.I)
_DOMAIN_POINT = re.compile(rf"(?:@{_LABEL}(?:(?:\.|[ \t]{{1,3}}(?:point|punto)[ \t]{{1,3}}){_LABEL})+"
                           rf"|[ \t]at[ \t]{{1,3}}{_LABEL}(?:(?:\.|[ \t]{{1,3}}punto[ \t]{{1,3}}){_LABEL})+"
                           rf"|[ \t]at[ \t]{{1,3}}{_LABEL}(?:(?:\.|[ \t]{{1,3}}point[ \t]{{1,3}}){_LABEL})*?"
                           r"[ \t]{1,3}point[ \t]{1,3}(?:com|org|net|edu|info|eu|fr|ch|ca|lu|de|es|uk)\b)", re.I)
_TAIL_DOT = re.compile(r"(?i)(?:[ ,.()-]{1,4}(?:dot|point|punkt|punto))+\Z")
_DIGIT_DOT = re.compile(r"(?i)[0-9][ \t]{0,3}(?:[\[({<][ \t]{0,3}\.|[\[({<]?[ \t]{0,3}(?:dot|punkt|punto|point)|[ \t]\.[ \t])")
_HAS_DOT = re.compile(r"(?i)dot|punkt|punto|point|[\[({<]\s{0,3}\.\s{0,3}[\])}>]")
_HAS_AT = re.compile(r"(?i)@|\bat\b|arroba|arobase|_at_")
# decimal digits of all scripts
_DECIMALS = "".join(chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) is not None)
_ODD = re.compile("[" + re.escape("".join(LOOK_ALIKES) + "".join(_HIDDEN) + "".join(_SIGNS))
                  + "！-～\U0001d400-\U0001d7ff①-⑨" + _DECIMALS + "]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(t: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from each @ outwards: linear also in long runs."""
    done, at = 0, t.find("@")
    while at >= 0:
        s = at
        while s > done and t[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(t, at + 1) if s < at else None
        if m:
            yield s, m.end()
            done = m.end()
        else:
            done = max(done, at)  # a run never reaches back over an @
        at = t.find("@", max(at + 1, done))


def find_base(t: str) -> list[Span]:
    """The contract's spans of a text, in order of start, then kind."""
    out: list[tuple[int, int, int]] = [(s, 0, e) for s, e in _emails(t)]
    for m in _IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(t):
        d = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(d) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


class Mapped:
    """A rewritten text and, per character, the source span it came from."""

    def __init__(self, text: str, starts: list[int] | range, ends: list[int] | range):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, text: str) -> Mapped:
        return cls(text, range(len(text)), range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace [start, end) of this text by each edit's string; every new
        character maps to the whole replaced source span. Edits are in order, apart."""
        if not edits:
            return self
        text, starts, ends, at = [], [], [], 0
        for s, e, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:s])
            starts.extend(self.starts[at:s])
            ends.extend(self.ends[at:s])
            if new:
                text.append(new)
                starts.extend([self.starts[s]] * len(new))
                ends.extend([self.ends[e - 1]] * len(new))
            at = e
        return Mapped("".join(text), starts, ends)

    def source(self, s: int, e: int) -> tuple[int, int]:
        return self.starts[s], self.ends[e - 1]


def _plain_char(c: str) -> str:
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if c in _SIGNS:
        return _SIGNS[c]
    if c in _HIDDEN:
        return ""
    n = unicodedata.normalize("NFKC", c)
    return n if n.isascii() else str(unicodedata.decimal(c)) if unicodedata.decimal(c, None) is not None else c


def homoglyphs(m: Mapped) -> Mapped:
    """Look-alike letters, wide and styled characters and invisible ones as plain ASCII."""
    return m.rewrite([(x.start(), x.end(), _plain_char(x[0])) for x in _ODD.finditer(m.text)])


def spelled_digits(m: Mapped) -> Mapped:
    """Runs of at least four digits of which three are words: one digit string.

    A leading plus stays; "dot"/"point" words between digits become points. Shorter runs stay as they are.
    """
    edits = []
    for x in _SPELLED.finditer(m.text):
        tail = _TAIL_DOT.search(x[0])
        end = x.start() + tail.start() if tail else x.end()  # a dot after the last digit belongs to what follows
        parts = _SPELLED_PART.findall(m.text[x.start():end])
        words = sum(bool(p[0]) for p in parts)
        new = "".join(DIGIT_WORDS[p[0].lower()] if p[0] else "+" if p[1] else p[2] or "." for p in parts)
        if words >= 3 and sum(c.isdigit() for c in new) >= 4:
            edits.append((x.start(), end, new))
    return m.rewrite(edits)


def _local_points(t: str) -> list[tuple[int, int]]:
    """Spans of the words "point" and "punto" between the parts of a name before an @, however many:
    from each @ to the left, part by part."""
    out: list[tuple[int, int]] = []
    if not _POINT.search(t):
        return out
    done = 0
    for x in re.finditer("@", t):
        end, own = x.start(), []
        while m := _LOCAL_POINT.search(t, max(done, end - 80), end):
            own.append(m.span(1))
            end = m.start(1)
        out += own[::-1]
        done = x.end()
    return out


def at_and_dot(m: Mapped) -> Mapped:
    """Bracketed, spaced and underscored at/dot disguises as @ and '.'."""
    for pattern, new in ((_BRACKET_DOT, "."), (_BRACKET_AT, "@"), (_SPACED_DOT, "."), (_CLEAR_AT, "@"), (_NUMBER_POINT, "."),
                         (_DOMAIN_POINT, None), (_SPACED_AT, "@"), (_LOCAL_POINT, "")):
        if new == "":
            m = m.rewrite([(x, y, ".") for x, y in _local_points(m.text)])
        elif new:
            m = m.rewrite([(x.start(), x.end(), new) for x in pattern.finditer(m.text)])
        elif _POINT.search(m.text):
            m = m.rewrite([(y.start(), y.end(), ".") for x in pattern.finditer(m.text) for y in _POINT.finditer(m.text, x.start(), x.end())])
    return m


def find_disguised(t: str, base: list[Span]) -> list[Span]:
    """Spans that only show in a rewritten text, outside all base spans.

    Cheap tests decide which transducers can matter for this text; all that
    can are composed, so mixed disguises are found too. An at written as a
    word counts only with a disguised dot in the same address: "at" alone is
    an ordinary word.
    """
    views: list[Mapped] = []
    plain = Mapped.of(t)
    odd = not t.isascii() and _ODD.search(t) is not None
    if odd:
        plain = homoglyphs(plain)
        views.append(plain)
    worked = [plain]
    if len(_ONE_DIGIT.findall(plain.text)) >= 3:
        spelled = spelled_digits(plain)
        if spelled is not plain:
            views.append(spelled)
            worked.append(spelled)
    for v in worked:
        marked = "@" in v.text or _BRACKET_AT.search(v.text) is not None
        if _HAS_AT.search(v.text) and (marked or _HAS_DOT.search(v.text)) or _DIGIT_DOT.search(v.text):
            views.append(at_and_dot(v))
    found: list[Span] = []
    for v in views:
        if v.text == t:
            continue
        for kind, s, e in find_base(v.text):
            a, b = v.source(s, e)
            src = t[a:b]
            if src == v.text[s:e]:
                continue  # nothing was disguised here: base rules decide
            if kind == "email" and not _believable(src, v.text[s:e]):
                continue
            found.append((kind, a, b))
    out: list[Span] = []
    taken = sorted((s, e) for _, s, e in base)
    for kind, s, e in sorted(set(found), key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        if all(e <= a or s >= b for a, b in taken):
            out.append((kind, s, e))
            taken.append((s, e))
    return out


def _believable(src: str, mail: str) -> bool:
    """An address from words needs a real or bracketed at (with blanks on neither or both
    sides: "see @name.x" is a mention), or a disguised dot, and a top-level name of letters;
    without one, "x at y. Z" would do."""
    if not re.fullmatch(r"[A-Za-z]{2,24}", mail.rsplit(".", 1)[-1]):
        return False
    explicit_at = "@" in src or "\uff20" in src or "\ufe6b" in src or _BRACKET_AT.search(src) or re.search(r"(?i)_at_|-at-", src)
    hidden_dot = _BRACKET_DOT.search(src) or _SPACED_DOT.search(src) or _POINT.search(src)
    spaced_at = re.search(r"(?i)\s@|@\s", src)
    if explicit_at and (not spaced_at or re.search("[ \\t][@\uff20\ufe6b][ \\t]", src)):
        return True
    return bool(hidden_dot)


def find_spans(t: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, ordered by start, then kind."""
    base = find_base(t)
    more = find_disguised(t, base)
    both = sorted([*base, *more], key=lambda x: (x[1], KINDS.index(x[0]), x[2])) if more else base
    return base, both


def redact(t: str, spans: list[Span]) -> str:
    """The text with every (merged) span replaced by the mask of its first kind."""
    merged: list[list] = []
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    cuts = [0, *(x for _, s, e in merged for x in (s, e)), len(t)]
    kept = [t[a:b] for a, b in list(pairwise(cuts))[::2]]
    return "".join(k + (MASKS[merged[i][0]] if i < len(merged) else "") for i, k in enumerate(kept))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone`` (base spans),
    ``base_sha256``, ``spans`` (all, ``kind:start:end`` comma-joined), ``n_added``.

    Null text is empty and has no spans; rows are kept one for one, repeated
    rows and null ids too; other columns are ignored.
    """
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: dict[str, list] = {f"n_{k}": [] for k in KINDS} | {"base_sha256": [], "spans": [], "n_added": []}
            for t in b.column(1):
                base, both = find_spans(t.as_py())
                for k in KINDS:
                    cols[f"n_{k}"].append(sum(x[0] == k for x in base))
                cols["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                cols["spans"].append(_joined(both))
                cols["n_added"].append(len(both) - len(base))
            kinds = {k: pa.string() if k in ("base_sha256", "spans") else pa.int64() for k in cols}
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0)} | {k: pa.array(v, kinds[k]) for k, v in cols.items()})

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(scan, schema))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` masked; all rows and columns stay, null text stays null."""
    schema, at = docs.schema, docs.columns.index(text_col)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if (t := x.as_py()) is None else redact(t, find_spans(t)[1]) for x in b.column(at)]
            cols = list(b.columns)
            cols[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(mask, schema)
