"""Scalar column expressions (survey I1-I21).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def agreeability_guarded(agrees="agrees", disagrees="disagrees") -> Column:
    """0 when nobody voted, else agrees / (agrees + disagrees)."""
    a, d = _c(agrees), _c(disagrees)
    return F.when(a + d == 0, F.lit(0.0)).otherwise(a.cast("double") / (a + d))


def agreeability(agrees="agrees", disagrees="disagrees") -> Column:
    """Agrees / (agrees + disagrees); NULL (not NaN) when nobody voted."""
    a, d = _c(agrees), _c(disagrees)
    return F.try_divide(a.cast("double"), (a + d).cast("double"))


def vote_sign(v="vote") -> Column:
    """1 / -1 / 0 by sign."""
    return F.signum(_c(v)).cast("int")


def percent_agree(agrees="agrees", disagrees="disagrees") -> Column:
    """Truncated whole percent; NULL when nobody voted."""
    a, d = _c(agrees), _c(disagrees)
    return F.floor(F.try_divide(a * 100, (a + d).cast("double"))).cast("int")


def argument_budget(n="n") -> Column:
    """ceil(2 ln n) arguments for a topic with n statements; 0 for n <= 1."""
    n = _c(n)
    return F.when(n <= 1, F.lit(0)).otherwise(F.ceil(F.ln(n) * 2)).cast("int")



def min_cluster_size(n="n") -> Column:
    """max(floor(n / 50), 4)."""
    return F.greatest(F.floor(_c(n) / 50), F.lit(4)).cast("int")


def label_code(label="classification") -> Column:
    """ACCEPT -> 1, UNSURE -> 0, any other label -> -1 (by name)."""
    x = _c(label)
    return (F.when(x == "ACCEPT", 1).when(x == "UNSURE", 0)
            .when(x.isNotNull(), -1).cast("int"))



def first_line(s) -> Column:
    """Text up to the first newline."""
    return F.substring_index(_c(s), "\n", 1)


def first_phrase(s) -> Column:
    """Text up to the first newline or period."""
    return F.get(F.split(_c(s), r"[\n.]", 2), 0)


# ---- fixed values (ours): abbreviations of the four fixture languages, whose period ends no sentence ----
ABBREVIATIONS = ["Dr", "Mr", "Mrs", "Ms", "Prof", "St", "No", "Nr", "vs", "etc", "e.g", "i.e", "z.B", "bzw", "ca", "Sr", "Sra", "Mme", "M"]
# the end of a sentence that isn't one, by a character that no text holds
ABBREVIATED = r"\b(" + "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS) + r")\."
SENTENCE = r"^\s*([^\n]*?[.!?](?:\s|$)|[^\n]+)"
_HELD = "\x01"


def first_sentence(s) -> Column:
    """The first sentence of a text, whole: up to a period, ``!`` or ``?`` before white space or the end, but
    not after an abbreviation, so "Dr. Smith" and "3.5 km" stay together; else the first line that isn't empty."""
    held = F.regexp_replace(_c(s), ABBREVIATED, "$1" + _HELD)
    return F.replace(F.trim(F.regexp_replace(F.regexp_extract(held, SENTENCE, 1), r"\s+$", "")), F.lit(_HELD), F.lit("."))


def first_tokens(s, n: int) -> Column:
    """First ``n`` whitespace tokens (the max-token cut of I17/I18)."""
    return F.array_join(F.slice(F.split(F.trim(_c(s)), r"\s+"), 1, n), " ")


def choice(s, options) -> Column:
    """The trimmed, upper-cased value if it is one of ``options``, else NULL."""
    x = F.upper(F.trim(_c(s)))
    return F.when(x.isin(list(options)), x)


def bounded_int(s, lo: int, hi: int) -> Column:
    """Integer in [lo, hi], else NULL."""
    v = F.trim(_c(s)).try_cast("int")
    return F.when((v >= lo) & (v <= hi), v)


def tokens(text) -> Column:
    """Lower-cased word tokens of two or more letters/digits (H5)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(r"([\p{L}\p{N}_]{2,})"), 1)


def bigrams(toks) -> Column:
    """Adjacent pairs joined by one space; empty for fewer than two tokens."""
    t = _c(toks)
    return F.when(F.size(t) < 2, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(t) - 1),
                    lambda i: F.concat_ws(" ", F.get(t, i - 1), F.get(t, i))))
