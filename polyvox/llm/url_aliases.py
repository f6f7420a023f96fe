r"""URL filters by redirect equivalence.

A page's own rule decides first: rules (verdict, host, path) fit their host and its subdomains where the
url's path starts with theirs, the longest rule wins. Pages without a rule take the method's
verdict: urls joined by redirects (``<meta http-equiv=refresh>`` or a given redirect log) and
canonical links (``<link rel=canonical>``) are aliases, connected components over those edges
are found in rounds on Spark, and a component with a url that a rule blocks is blocked,
crawled or not. An explicit allow takes precedence for the url that it names: such a page
stays allowed in a blocked component; it doesn't lift the block for its aliases. Without a
blocked alias the verdict is allow.

Everything is DataFrame expressions. Rules compile into hash-set tests of a url's host suffixes
and path prefixes, so no shuffle is needed for them and a popular host costs nothing extra. Only
edges move, as 128-bit digests of urls; the way back to the pages is a join salted for urls that very many
pages share.

Defined results. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path:
what follows up to ``?``, ``#`` or the end; null or no ``://``: both empty, no rule
(a null url has no aliases either and is allowed). Equally long rules: allow
first, then the longer host. A url's identity ignores its fragment and the case of scheme and host; ``http`` and
``https`` differ unless an edge joins them. Links inside comments and scripts don't count, a tag ends at its
first ``>``; relative links are resolved against the page's url; ``<base>`` is not followed; links to
other schemes than http and https are no edges. Null html has no links. Repeated rows each return a row. An empty
table gives no rows. Columns besides page_id, url and html don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyvox.llm.common import components, staged
from polyvox.operators.skew import salted_join

#: Fixed rules of the registered query: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Comments and scripts are matched first, so that what they hold is not taken for a tag.
_TAGS = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<(?:link|meta)\b[^>]*>"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lower_ascii(c: str | Column) -> Column:
    return F.translate(_c(c), _UPPER, _LOWER)


def after_scheme(url: str | Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(_c(url), "://")
    return F.coalesce(F.when(at > 0, F.substr(_c(url), at + 3)), F.lit(""))


def host(url: str | Column) -> Column:
    return lower_ascii(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0))


def path(url: str | Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: str, path: str, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.

    A url's candidates are its host and the host's parent domains, each with the prefixes of its path whose
    lengths occur in the rules; a candidate is looked up in the set of rules."""
    verdicts: dict[tuple[str, str], str] = {}
    for verdict, h, p in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"a rule's verdict is allow or block, not {verdict!r}")
        k = (h.translate(str.maketrans(_UPPER, _LOWER)), p)
        verdicts[k] = "allow" if "allow" in (verdict, verdicts.get(k)) else "block"
    if not verdicts:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    labels = F.split(F.col(host), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.array(*[F.lit(n) for n in sorted({len(p) for _, p in verdicts})])
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substr(F.col(path), F.lit(1), n))
    known = {v: ["\0".join(k) for k, got in verdicts.items() if got == v] for v in ("allow", "block")}
    fits = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(
        (F.length(h) + F.length(p)).alias("n"),
        F.concat(h, F.lit("\0"), p).isin(known["allow"]).alias("allowed"),
        F.length(h).alias("h"), F.concat(h, F.lit("\0"), p).alias("key")))))
    best = F.array_max(F.filter(fits, lambda x: x["allowed"] | x["key"].isin(known["block"])))
    return F.when(best.isNotNull(), F.struct(
        F.replace(best["key"], F.lit("\0"), F.lit("")).alias("rule"),
        F.when(best["allowed"], F.lit("allow")).otherwise(F.lit("block")).alias("verdict")))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value (double-quoted, single-quoted or bare), null if absent."""
    pattern = rf"(?is)[\s\"'/]{name}{_VALUE}"
    groups = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.when(tag.rlike(pattern), F.concat(*groups))


def _target(tag: Column) -> Column:
    """The url that a link or meta tag makes an alias of its page, else null."""
    canonical = tag.rlike("(?is)^<link") & F.concat(F.lit(" "), _attribute(tag, "rel"), F.lit(" ")).rlike(r"(?i)\scanonical\s")
    refresh = tag.rlike("(?is)^<meta") & _attribute(tag, "http-equiv").rlike(r"(?i)^\s*refresh\s*$")
    to = F.regexp_extract(_attribute(tag, "content"), r"(?is)^[\s0-9.]*[;,\s]\s*url\s*=\s*[\"']?([^\"']*)", 1)
    return F.trim(F.replace(F.when(canonical, _attribute(tag, "href")).when(refresh, F.nullif(to, F.lit(""))), F.lit("&amp;"), F.lit("&")))


def resolved(link: Column, base: Column) -> Column:
    """``link`` as an absolute url, seen from ``base``; null where neither is absolute http(s)."""
    scheme = F.regexp_extract(base, "(?i)^(https?):", 1)
    origin = F.regexp_extract(base, "(?i)^https?://[^/?#]*", 0)
    here = F.regexp_replace(base, "[?#].*$", "")
    folder = F.regexp_extract(path(base), "^.*/", 0)
    climbed = F.when(link.startswith("/"), link).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), link))
    tail = F.regexp_extract(climbed, r"(?s)[?#].*$", 0)
    segments = F.split(F.regexp_replace(climbed, r"(?s)[?#].*$", ""), "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda to, s:
                       F.when(s == ".", to).when(s == "..", F.when(F.size(to) > 1, F.slice(to, 1, F.size(to) - 1)).otherwise(to))
                       .otherwise(F.concat(to, F.array(s))))
    walked = F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit("")), tail)
    got = (F.when(link.rlike("(?i)^https?://"), link)
           .when(link.rlike("(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None).cast("string"))
           .when(origin == "", F.lit(None).cast("string"))
           .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
           .when((link == "") | link.startswith("#"), base)
           .when(link.startswith("?"), F.concat(here, link))
           .otherwise(F.concat(origin, walked)))
    return got


def identity(url: str | Column) -> Column:
    """The url without its fragment, scheme and host in lower case: what an alias edge joins."""
    u = F.regexp_replace(_c(url), "(?s)#.*$", "")
    head = F.regexp_extract(u, "(?s)^[^:/?#]*://[^/?#]*", 0)
    return F.concat(lower_ascii(head), F.substr(u, F.length(head) + 1))


def alias_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst)`` urls joined by the pages' refresh and canonical tags."""
    p = (pages.select(F.col("url").alias("src"), F.col("html").alias("html"))
         .filter(F.col("src").isNotNull() & F.col("html").rlike("(?i)canonical|http-equiv")))
    # one scan of the html
    tags = F.filter(F.regexp_extract_all("html", F.lit(_TAGS), F.lit(0)), lambda t: t.rlike("(?is)^<(link|meta)"))
    link = p.select("src", F.explode(tags).alias("tag")).select("src", _target(F.col("tag")).alias("link")).filter("link is not null")
    return (link.select("src", resolved(F.col("link"), F.col("src")).alias("dst")).filter("dst is not null")
            .select(identity("src").alias("src"), identity("dst").alias("dst")).filter("src <> dst").distinct())


def blocked_aliases(edges: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``node`` digests of urls in a component that holds a url which a rule blocks."""
    e = edges.select("src", "dst", F.unhex(F.md5("src")).alias("a"), F.unhex(F.md5("dst")).alias("b"))
    e = staged(e, "aliases")
    urls = (e.select(F.col("a").alias("node"), F.col("src").alias("url"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("dst").alias("url"))))
    named = urls.select("node", host("url").alias("h"), path("url").alias("p"))
    seeds = named.filter(matching_rule("h", "p", rules)["verdict"] == "block").select("node").distinct()
    member = staged(components(e.select("a", "b")), "members")
    bad = member.join(seeds, "node").select("root").distinct()
    return salted_join(member, bad, ["root"], ["node"]).select("node").distinct()


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` for every row of ``pages(page_id, url, html)``.

    ``redirects(src, dst)``, absolute urls of a crawl's redirect log, add to the pages' own edges."""
    edges = alias_edges(pages)
    if redirects is not None:
        given = redirects.select(identity("src").alias("src"), identity("dst").alias("dst"))
        edges = edges.unionByName(given.filter("src <> dst")).distinct()
    bad = blocked_aliases(edges, rules).withColumn("bad", F.lit(True))
    p = pages.select("page_id", "url", host("url").alias("host"), path("url").alias("path"), F.unhex(F.md5(identity("url"))).alias("node"))
    p = p.withColumn("found", matching_rule("host", "path", rules))
    # salted by page and url: rows of a url that very many pages share spread
    return (salted_join(p, bad, ["node"], ["page_id"], "left")
            .select("page_id", "url", "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce("found.verdict", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict")))


def judged(pages: DataFrame) -> DataFrame:
    """The contract's columns under RULES."""
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")
