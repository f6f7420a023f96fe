"""Vector codes, pivot clustering and URL aliases against brute force."""

import hashlib
import math
import random
from urllib.parse import urljoin

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from polyvox.llm import ptolemy, queries, url_aliases, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, id long, codes string, error long, n int, part int, cluster int, q int"


def frame(spark, rows):
    """Rows (vec_id, embedding, label) with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 7, "x", 7, 7, 7, 7, 7) for r in rows], SCHEMA).repartition(5)


def awkward_vectors(dims, n, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1 / 3, rng.gauss(0, 1)]) for _ in range(dims)], rng.choice([None, 1, 2, 3])) for i in range(n)]
    rows += [(1000, None, 1), (1001, [None] * dims, 1), (1002, [math.nan] + [0.1] * (dims - 1), 2), (1003, [math.inf] * dims, 2),
             (1004, [-math.inf] + [0.1] * (dims - 1), None), (3, rows[3][1], 2), (3, rows[3][1], 2), (1005, rows[3][1], None),
             (None, rows[5][1], 1), (2000, [-1e-9] * dims, 9)]
    return rows


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(np.float32(x)) for x in r[1])]


def ints(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def order(r):
    return (r[0] is None, r[0] or 0, [np.float32(x) for x in r[1]])


# --- vector codes ------------------------------------------------------------

@pytest.mark.parametrize("m", [1, 2, 3, 4, 5, 16])
def test_transform_keeps_distances_in_sequency_order(m):
    rng = np.random.default_rng(m)
    x, y = rng.integers(-1000, 1000, (2, 50, m))
    p = vector_codes.padded(m)
    assert (((vector_codes.transformed(x) - vector_codes.transformed(y)) ** 2).sum(1) == p * ((x - y) ** 2).sum(1)).all()
    walsh = vector_codes.transformed(np.eye(p, dtype=np.int64)).T  # row s: the s-th function
    assert ((np.diff(walsh, axis=1) != 0).sum(1) == np.arange(p)).all()


@pytest.mark.parametrize("m", [1, 3, 4, 8])
def test_early_elimination_finds_the_first_nearest(m):
    rng = np.random.default_rng(m)
    x, e = rng.integers(-3, 3, (400, m)), rng.integers(-3, 3, (64, m))  # few values: many ties
    at, d = vector_codes.nearest(vector_codes.transformed(x), vector_codes.transformed(e))
    full = ((x[:, None] - e) ** 2).sum(2)
    assert (at == full.argmin(1)).all() and (d == full.min(1)).all()


def brute_codes(rows):
    kept = sorted(usable(rows), key=order)
    width = -(-max((len(r[1]) for r in kept), default=0) // 16) * 16
    m = width // 16
    q = [ints(r[1], 256) + [0] * (width - len(r[1])) for r in kept]
    parts = [[v[j * m:j * m + m] for j in range(16)] for v in q]
    books = [[v[j] for v in parts[:64]] for j in range(16)]

    def best(j, s):
        return min((sum((a - b) ** 2 for a, b in zip(s, e)), i) for i, e in enumerate(books[j]))
    for _ in range(2):
        new = []
        for j in range(16):
            groups = {}
            for v in parts:
                groups.setdefault(best(j, v[j])[1], []).append(v[j])
            new.append([[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[j])])
        books = new
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = [[best(j, v[j]) for j in range(16)] for v in parts]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted((str(r[0]), "".join(f"{i:02x}" for _, i in f), e, by_label[r[2]], digest) for r, f, e in zip(kept, found, errors))


@pytest.mark.parametrize("dims,n", [(64, 150), (32, 20), (48, 90)])
def test_codes_equal_brute_force(spark, dims, n):
    rows = awkward_vectors(dims, n, dims)
    got = vector_codes.compressed(frame(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert dict(got.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_codes(rows)


def test_codes_of_odd_lengths_and_empty_tables(spark):
    rows = [(i, [float(i * j % 7) for j in range(i % 21)], i % 2) for i in range(80)]
    assert sorted((str(r[0]), *r[1:]) for r in vector_codes.compressed(frame(spark, rows)).collect()) == brute_codes(rows)
    assert vector_codes.compressed(frame(spark, rows).filter("1 = 0")).count() == 0
    empty = vector_codes.compressed(frame(spark, [(1, [], 1), (2, [], 1)])).collect()
    assert [(r["code"], r["error"]) for r in empty] == [("00" * 16, 0)] * 2
    with pytest.raises(Exception, match="exact 64-bit"):
        vector_codes.compressed(frame(spark, [(1, [1e30] * 64, 1)])).collect()


def test_decoded_codes_are_as_far_as_their_error(spark):
    rows = awkward_vectors(64, 90, 4)
    codes, books = vector_codes.compress(frame(spark, rows))
    vectors = {r[0]: ints(r[1], 256) for r in usable(rows)}
    for r in codes.collect():
        gap = np.array(vectors[r["vec_id"]]) - vector_codes.decode(r["codes"], books)
        assert (gap ** 2).sum() == r["error"]


# --- pivot clustering --------------------------------------------------------

def brute_clusters(rows, rounds=3):
    kept = [r for r in usable(rows) if len(r[1]) == 64]
    key = {id(r): (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), [np.float32(x) for x in r[1]]) for r in kept}
    cents = [ints(r[1], 64) for r in sorted((r for r in kept if r[0] is not None), key=lambda r: key[id(r)])[:16]]
    q = [ints(r[1], 64) for r in kept]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for v in q:
            groups.setdefault(best(v)[1], []).append(v)
        cents = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(cents)]
    found = [best(v) for v in q] if cents else []
    inertia = {}
    for d, i in found:
        inertia[i] = inertia.get(i, 0) + d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(r[0]), i, d, inertia[i], sum(inertia.values()), name[i]) for r, (d, i) in zip(kept, found))


@pytest.mark.parametrize("n", [3, 12, 200])
def test_clusters_equal_brute_force(spark, n):
    rows = awkward_vectors(64, max(n, 6), n)[-n - 10:] + [(7000 + i, [0.5] * k, 1) for i, k in enumerate((0, 1, 63, 65))]
    got = ptolemy.clustered(frame(spark, rows))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert dict(got.dtypes)["cluster"] == "int"
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_clusters(rows)


def test_clusters_of_equal_and_missing_rows(spark):
    same = [(1, [0.5] * 64, 1)] * 30 + [(2, [0.5] * 64, 1)]
    assert sorted((str(r[0]), *r[1:]) for r in ptolemy.clustered(frame(spark, same)).collect()) == brute_clusters(same)
    assert ptolemy.clustered(frame(spark, same).filter("1 = 0")).count() == 0
    assert ptolemy.clustered(frame(spark, [(None, [0.5] * 64, 1)])).count() == 0


def test_bounds_never_exceed_distances_and_spare_work():
    rng = np.random.default_rng(5)
    heads = rng.integers(-60, 60, (16, 64))
    x = np.concatenate([heads[rng.integers(0, 16, 500)] + rng.integers(-3, 4, (500, 64)), heads, heads[:1].repeat(20, 0)])
    pivots = ptolemy.choose_pivots(heads)
    assert len(pivots) == ptolemy.PIVOTS
    near = np.stack([ptolemy.squared(x, p) for p in pivots], 1)
    low = ptolemy.lower_bounds(near, np.stack([ptolemy.squared(heads, p) for p in pivots], 1), pivots)
    full = ((x[:, None] - heads) ** 2).sum(2)
    assert all(float(b) ** 2 <= int(d) for b, d in zip(low.ravel(), full.ravel()))
    at, d, measured = ptolemy.assign(x, near, heads, pivots)
    assert (at == full.argmin(1)).all() and (d == full.min(1)).all() and measured < 0.6 * full.size


# --- URL aliases ---------------------------------------------------------------

def page(url, *links):
    return url, "<html><head>" + "".join(links) + "</head><body><a href='/x'>x</a></body></html>"


def canonical(to):
    return f'<link rel="canonical" href="{to}">'


def refresh(to):
    return f"<META content='0; URL={to}' http-equiv=refresh />"


PAGES = [
    page("http://a.example.net/one", canonical("http://b.example.net/two")),
    page("http://b.example.net/two", refresh("http://c.example.net/three")),
    page("http://c.example.net/three", canonical("http://www.example.org/es/bad")),       # not crawled, blocked by rule
    page("http://d.example.net/four"),
    page("http://www.example.org/de/ok", canonical("http://b.example.net/two#top")),      # explicit allow in the blocked component
    page("http://e.example.net/x/y", "<link href='/x/z' rel='alternate canonical'>"),
    page("http://e.example.net/x/z?q", "<!-- ", canonical("http://c.example.net/three"), " -->"),
    page("http://e.example.net/x/q", "<script>var a='", canonical("http://c.example.net/three"), "'</script>"),
    page("http://f.example.net", canonical("//M.example.com/de/1")),
    page("HTTP://F.example.net#again"),
    page("http://g.example.net/p", canonical("mailto:x@example.org"), "<link rel=canonical>", "<meta http-equiv=refresh content=5>"),
    page("http://g.example.net/p?a=1&amp;b", canonical("?r=2")),
    page("http://g.example.net/p?r=2", canonical("http://www.example.org/en/12&amp;x")),
    page("no scheme at all", canonical("http://c.example.net/three")),
    page(None, canonical("http://c.example.net/three")),
    ("http://h.example.net/", None), ("http://h.example.net/", ""), ("://", "x"), ("http://ORG/", ""), ("http://org", ""),
    ("http://example.org/en/2", ""), ("http://notexample.org/es/", ""), ("http://x.Example.org/es/?a", ""), ("http://com/fr/", ""),
    ("http://x.com/fr", ""), ("https://u@x.com:80/de/", ""), ("ftp://a.b.com/de/#f", "é" * 100_000),
]


def pages(spark, rows):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return df.select("*", *[F.lit("x").alias(c) for c in ("host", "path", "node", "rule", "bad", "a", "src", "tag")])


def test_verdicts_follow_aliases(spark):
    got = {r["page_id"]: r for r in url_aliases.judged(pages(spark, PAGES)).collect()}
    assert len(got) == len(PAGES)
    blocked = {i for i, r in got.items() if r["rule"] is None and r["verdict"] == "block"}
    assert blocked == {0, 1, 2, 8, 9, 11, 12, 13}
    assert (got[4]["rule"], got[4]["verdict"]) == ("org/", "allow")
    assert (got[22]["rule"], got[22]["verdict"], got[22]["host"], got[22]["path"]) == ("example.org/es/", "block", "x.example.org", "/es/")
    assert [got[i]["rule"] for i in (18, 19, 20, 21, 23, 24)] == ["org/", None, "org/", "org/", "com/fr/", None]
    assert [(got[i]["host"], got[i]["path"], got[i]["verdict"]) for i in (13, 14, 17)] == [("", "", "block"), ("", "", "allow"), ("", "", "allow")]
    assert got[25]["rule"] is None and got[26]["rule"] == "com/de/"


def test_url_sql_agrees(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(i, u, h) for i, (u, h) in enumerate(PAGES)])
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({queries.OP12_SQL})").fetchall()
    assert sorted(map(tuple, url_aliases.judged(pages(spark, PAGES)).collect())) == sorted(want)


def test_redirect_log_and_empty_tables(spark):
    rows = pages(spark, [("http://a.net/1", ""), ("http://b.net/2", ""), ("http://c.net/", None)])
    log = spark.createDataFrame([("http://a.net/1", "HTTP://B.net/2"), ("http://b.net/2#f", "http://bad.net/"), ("http://c.net/", "http://c.net/")],
                                "src string, dst string")
    rules = [("block", "bad.net", "/"), ("allow", "b.net", ""), ("block", "b.net", "")]  # the last two tie: allow wins
    assert [r["verdict"] for r in url_aliases.judge(rows, rules, log).orderBy("page_id").collect()] == ["block", "allow", "allow"]
    assert [r["verdict"] for r in url_aliases.judge(rows, [], log).orderBy("page_id").collect()] == ["allow"] * 3
    assert url_aliases.judged(rows.filter("1 = 0")).count() == 0
    with pytest.raises(ValueError):
        url_aliases.judge(rows, [("maybe", "a", "/")])


def test_links_resolve_like_urljoin(spark):
    bases = ["http://h.net", "http://h.net/", "http://h.net/a/b", "http://h.net/a/b/?q=/x/y", "https://h.net/a/b#f"]
    links = ["", "x", "./x", "../x", "../../../x", "/x/../y", "/x/./", "..", "?p=1", "//o.net/z", "http://o.net/./k", "x?y=../z", "x#f"]
    df = spark.createDataFrame([(b, k) for b in bases for k in links], "base string, link string")
    got = {(r[0], r[1]): r[2] for r in df.select("base", "link", url_aliases.identity(url_aliases.resolved(F.col("link"), F.col("base")))).collect()}
    for (b, k), to in got.items():
        want = urljoin(b, k).split("#")[0]
        assert to == want, (b, k)


def test_hub_of_many_aliases(spark):
    """A third of all pages name one blocked url as canonical; a chain reaches it too."""
    rows = [page(f"http://s{i % 7}.example.net/{i}", *([canonical("http://x.com/de/hub")] if i % 3 == 0 else [])) for i in range(600)]
    rows += [page(f"http://chain.example.net/{i}", refresh(f"/{i + 1}")) for i in range(12)]
    rows.append(page("http://chain.example.net/12", canonical("http://s0.example.net/0")))
    got = {r["page_id"]: r["verdict"] for r in url_aliases.judged(pages(spark, rows)).collect()}
    assert {i for i, v in got.items() if v == "block"} == {*range(0, 600, 3), *range(600, 613)}
