"""Argdown text builders as column expressions.

Each function returns a string Column for one map element, so a whole map
is a table of (sort keys, text) rows built and written in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's output format) --------------
AI_EMOJI = "🤖"
HUMAN_EMOJI = "🙂"
FRONT_MATTER = """===
sourceHighlighter:
    removeFrontMatter: true
webComponent:
    withoutMaximize: true
    height: 1000px
model:
    removeTagsFromText: true
# map:
#     statementLabelMode: text
#     argumentLabelMode: text
selection:
    excludeDisconnected: false
color:
    tagColors:
        Human: "#99cc99"
        AI: "#9999cc"
===

"""
# ---------------------------------------------------------------------------


def _nl() -> Column:
    return F.lit("\n")


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def emoji(tag: str) -> str:
    return AI_EMOJI if tag == "AI" else HUMAN_EMOJI


def heading(label, content=None) -> Column:
    """``\\n# label\\n`` [+ ``\\ncontent\\n``]."""
    base = F.concat(_nl(), F.lit("# "), _c(label), _nl())
    return base if content is None else F.concat(base, _nl(), _c(content), _nl())


def supports(label, argument: bool = False) -> Column:
    """``  +> [label]`` or ``  +> <label>``."""
    return (F.concat(F.lit("  +> <"), _c(label), F.lit(">\n")) if argument
            else F.concat(F.lit("  +> ["), _c(label), F.lit("]\n")))


def supported_by(label) -> Column:
    """R5."""
    return F.concat(F.lit("  + ["), _c(label), F.lit("]\n"))


def refuted_by(label) -> Column:
    """R6."""
    return F.concat(F.lit("  - ["), _c(label), F.lit("]\n"))


def refutes(label) -> Column:
    """R7."""
    return F.concat(F.lit("  -> ["), _c(label), F.lit("]\n"))


def _node(label, body, tag: str, brackets: str, link: Column | None = None) -> Column:
    """A map element on lines of its own: bracketed label, emoji, body, tag, then its link if it has one."""
    parts = [_nl(), F.lit(brackets[0]), _c(label), F.lit(f"{brackets[1]}: {emoji(tag)} "), _c(body), F.lit(f" #{tag}\n")]
    return F.concat(*parts, *([link] if link is not None else []))


def _link(to_label, to_argument) -> Column | None:
    """R8 towards a statement or an argument (a statement wins), None without a target."""
    targets = [(to_label, False), (to_argument, True)]
    return next((supports(t, argument=is_argument) for t, is_argument in targets if t is not None), None)


def topic(name, content, supports_label=None, tag: str = "AI") -> Column:
    """R2: ``\\n[name]: emoji content #tag\\n`` [+ R8]."""
    return _node(name, content, tag, "[]", _link(supports_label, None))


def argument(label, content, supports_label=None, supports_argument=None, tag: str = "AI") -> Column:
    """``\\n<label>: emoji content #tag\\n`` [+ R8]."""
    return _node(label, content, tag, "<>", _link(supports_label, supports_argument))


def comment(label, text, supports_label=None, supports_argument=None, tag: str = "Human") -> Column:
    """``\\n[label]: emoji comment #tag\\n`` [+ R8]."""
    return _node(label, text, tag, "[]", _link(supports_label, supports_argument))


def template_head() -> str:
    """The front matter before the body (the body is followed by one
    newline)."""
    return FRONT_MATTER


def fence(as_map: bool = False) -> tuple[str, str]:
    """What stands before and after a document in Markdown; ``as_map`` shows it as a map."""
    return f"```argdown{'-map' if as_map else ''}\n", "\n```\n"


def document(body) -> Column:
    """A whole document: front matter, body, newline."""
    return F.concat(F.lit(template_head()), _c(body), _nl())


def markdown(body, as_map: bool = False) -> Column:
    """A whole document in a Markdown block."""
    opening, closing = fence(as_map)
    return F.concat(F.lit(opening), document(body), F.lit(closing))


def pct(x) -> Column:
    """I11 for map bodies: ``{x*100:.1f}`` rounding half-even like Python;
    NULL ratio -> ``n/a``."""
    return F.coalesce(F.format_string("%.1f", F.bround(_c(x) * 100, 1)), F.lit("n/a"))
