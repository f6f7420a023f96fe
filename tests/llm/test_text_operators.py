"""Text operators against brute force, on awkward rows and on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from polyvox.llm import bpe, decontaminate, langid, ngram_join, pii, queries, suffix_dedup, token_counts, toxicity
from polyvox.plans.check import duck, frame_rows

SMALL = "/root/testdata/sf0.001"
VOCABULARY = f"{queries.TOKENIZERS}/{queries.WORDPIECE_VOCABULARY}"
TOKENIZER = f"{queries.TOKENIZERS}/{queries.BPE_TOKENIZER}"


def rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# --- 2: token counts ---------------------------------------------------------

def test_longest_match_equals_greedy():
    rng = random.Random(3)
    for _ in range(60):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 14))}
        pieces |= {b" " + p for p in list(pieces)[:rng.randint(0, 8)]} | ({b" "} if rng.random() < 0.5 else set())
        auto = token_counts.LongestMatch(sorted(pieces))
        for _ in range(60):
            w = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 12)))
            assert auto.count(w) == token_counts.greedy_count(pieces, w), (pieces, w)


def test_token_counts_awkward(awkward, nothing):
    pieces = token_counts.load_vocabulary(VOCABULARY)
    have = set(pieces)
    got = sorted(map(tuple, token_counts.token_counts(awkward, pieces).select("doc_id", "n_words", "n_tokens").collect()), key=str)
    want = sorted(((i, len(t.split()), sum(token_counts.greedy_count(have, w.encode()) for w in t.split())) for i, t in rows(awkward)), key=str)
    assert got == want
    assert token_counts.token_counts(nothing, pieces).count() == 0


# --- 4: personal data --------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        n = [int(c) for c in reversed(d)]
        return (sum(n[::2]) + sum(sum(map(int, str(2 * x))) for x in n[1::2])) % 10 == 0

    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15]
    return [(pii.KINDS[k], s, e) for s, k, e in sorted(out)]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(5)
    parts = ["a@b.c", "a.b%+@x-y.org", "@", "..", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1111",
             "+1 (555) 555-1234", "+49.30.1234567", "12", " ", "-", "x", "é", "@@", "a@b", "0" * 30, "+", "(", "9 9"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert pii.find_base(t) == plain_spans(t), t


@pytest.mark.parametrize(("text", "kind", "source"), [
    ("write to jo [at] example [dot] com now", "email", "jo [at] example [dot] com"),
    ("write to jo(at)example(dot)com.", "email", "jo(at)example(dot)com"),
    ("write to jo at example dot com today", "email", "jo at example dot com"),
    ("write to jоe@exаmple.com now", "email", "jоe@exаmple.com"),
    ("write to jo＠example．com", "email", "jo＠example．com"),
    ("call plus one five five five five five five one two three four ok", "phone", "plus one five five five five five five one two three four"),
    ("ip one nine two dot one six eight dot one dot one here", "ip", "one nine two dot one six eight dot one dot one"),
    ("card four one one one one one one one one one one one one one one one end", "card", " ".join(["four"] + ["one"] * 15)),
    ("ip １９２.168.1.1", "ip", "１９２.168.1.1"),
    ("call +1 (nine eight eight) five five five-two four eight five, ok", "phone", "+1 (nine eight eight) five five five-two four eight five"),
    ("at 42 dot 144 dot 35 dot 254 since", "ip", "42 dot 144 dot 35 dot 254"),
    ("host 42[.]144[.]35[.]254 up", "ip", "42[.]144[.]35[.]254"),
    ("me: bo.42 @ mail8 . example . com!", "email", "bo.42 @ mail8 . example . com"),
    ("me: bo dot 42 at mail8 dot example dot com ok", "email", "bo dot 42 at mail8 dot example dot com"),
    ("mе: b​o.42 [аt] mail8 [dot] example [dot] cоm", "email", "b​o.42 [аt] mail8 [dot] example [dot] cоm"),
])
def test_disguised_spans_map_back(text, kind, source):
    base, both = pii.find_spans(text)
    assert (kind, text.index(source), text.index(source) + len(source)) in both
    assert set(base) <= set(both)
    assert source not in pii.redact(text, both)


@pytest.mark.parametrize("kind, source", [
    ("email", "ana arroba ejemplo punto com"), ("email", "jean arobase exemple point fr"), ("email", "jean at exemple point fr"),
    ("email", "ann at example dot com"), ("email", "anna at beispiel punkt de"),
    ("email", "ana punto ruiz [at] correo punto ejemplo punto com"), ("email", "jean point roux @ exemple point fr"),
    ("ip", "192 punto 168 punto 1 punto 10"), ("ip", "192 point 168 point 1 point 10"),
    ("ip", "192 dot 168 dot 1 dot 10"), ("ip", "192 punkt 168 punkt 1 punkt 10"),
    ("email", "john @ example.com"), ("email", "anna @ beispiel.de"), ("email", "ana @ ejemplo.es"), ("email", "jean @ exemple.fr"),
    ("email", "one two three four at example dot com"), ("email", "eins zwei drei vier at beispiel punkt de"),
    ("email", "uno dos tres cuatro arroba ejemplo punto com"), ("email", "un deux trois quatre arobase exemple point fr"),
    ("email", "ann at one two three four dot com"),
])
def test_worded_disguises_in_four_languages(kind, source):
    text = f"-- {source} !"
    both = pii.find_spans(text)[1]
    assert (kind, 3, 3 + len(source)) in both
    assert source not in pii.redact(text, both)


@pytest.mark.parametrize("text", ["We met at this point in time, at some point we left.", "hey @ann.lee look", "at 3 point 5 or 2 punto 4",
                                  "El punto de venta. A ese punto llegamos.", "Le point de vue at noon."])
def test_ordinary_points_have_no_spans(text):
    assert pii.find_spans(text)[1] == []


@pytest.mark.parametrize("text", ["she was at home. Then we met at noon.", "meet me at the end dot", "one two three go", "", "αβγ δεζ",
                                  "The point at hand. One, two, three and four of seven."])
def test_clean_text_has_no_spans(text):
    assert pii.find_spans(text)[1] == []


def test_personal_data_long_and_awkward(awkward, nothing):
    got = {r["doc_id"]: r for r in pii.personal_data(awkward).filter("doc_id = 12").collect()}
    assert (got[12]["n_email"], got[12]["n_phone"]) == (1, 1)
    assert pii.personal_data(awkward).count() == awkward.count() and pii.personal_data(nothing).count() == 0
    masked = pii.redacted(awkward)
    assert masked.columns == awkward.columns and masked.count() == awkward.count()
    assert masked.filter("text is null").count() == awkward.filter("text is null").count()
    long = "a" * 200_000 + "@" * 1000 + "1" * 100_000 + "." * 1000
    assert pii.find_spans(long)[0] == []


# --- 5: decontamination ------------------------------------------------------

def brute_contamination(text, items, size=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = lambda t: word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, found = fold(text), set(), set()
    for item, t in items:
        iw = fold(t)
        n = min(size, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if iw else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(item))
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def contamination_case(spark):
    rng = random.Random(9)
    words = ["a", "b", "C", "d", "É", "é", "x1"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n)) if n >= 0 else None
    items = [(i, text(rng.choice([0, 1, 3, 12, 13, 14, 30]))) for i in range(8)] + [(3, None), (99, "İx Kk a a")]
    docs = [(i, (text(rng.randint(0, 30)) or "") + ", " + (rng.choice(items)[1] or "").upper() + "! " + (text(5) or "")) for i in range(60)]
    docs += [(70, None), (71, ""), (None, items[6][1]), (5, docs[5][1]), (72, "İx Kk a a"), (73, "i̇x kk a a")]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_contamination_equals_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    docs, items, d, b = contamination_case(spark)
    got = sorted((tuple(r) for r in decontaminate.contamination(d, b).drop("tid").collect()), key=str)
    want = sorted(((i, *brute_contamination(t, items)) for i, t in docs), key=str)
    assert got == want
    kept = sorted((tuple(r) for r in decontaminate.clean(d, b).collect()), key=str)
    assert kept == sorted(((i, t) for i, t in docs if not brute_contamination(t, items)[-1]), key=str)


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_items_of_null_id_contaminate(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    docs = [(1, "see one two here"), (2, "three four"), (3, "one two three four five six"), (4, "none of it")]
    items = [(None, "one two"), (None, "five six"), (7, "three four")]
    got = sorted(tuple(r) for r in decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).drop("tid").collect())
    con = duckdb.connect()
    for name, key, data in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)
    assert got == sorted(con.execute(queries.OP5_SQL).fetchall())
    assert [r[1:4] + r[5:] for r in got] == [(4, 2, 1, True), (2, 2, 1, True), (6, 6, 2, True), (3, 0, 0, False)]


def test_contamination_awkward(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string")
    got = decontaminate.contamination(awkward, bench)
    assert got.count() == awkward.count()
    assert {r["doc_id"] for r in got.filter("contaminated").collect()} == {9, 10}
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert decontaminate.contamination(awkward, bench.filter("1 = 0")).filter("n_hit > 0").count() == 0


# --- 6: toxicity -------------------------------------------------------------

def windows(*strings):
    return [toxicity.piece(x) for x in strings]


def test_folded_weights_equal_landmark_margins():
    toxic, clean = windows("loser", "clown", "moron", "go die", "shut up"), windows("river", "house", "table", "lower", "crown", "go home", "up to")
    strings = windows("loser", "l.o.s.e.r", "losser", "lo ser", "house", "river", "moronic", "shut it up", "a", "anananan")
    rng = np.random.default_rng(3)
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    marks = toxic[:3] + clean[:5]
    model = toxicity._trained(toxic + clean, y, marks, np.random.default_rng(3))
    f, white = toxicity.nystroem(toxic + clean, marks)
    w, bias = toxicity._svm(f, y, rng)
    unfolded = toxicity.kernel(strings, marks) @ white @ w + bias
    assert np.abs(model.margins(strings) - unfolded).max() < 1e-9
    m = dict(zip(["loser", "dots", "double", "blank", "house", "river"], model.margins(strings)))
    assert min(m["loser"], m["dots"], m["double"], m["blank"]) > max(m["house"], m["river"])
    # the kernel itself, subsequence by subsequence
    def brute(a, b):
        def phi(x):
            x, out, norm = [toxicity._START, *x, toxicity._END], {}, 0
            for i in range(len(x)):
                for j in range(i + 1, len(x)):
                    for k in range(j + 1, min(len(x), i + toxicity.SPAN)):
                        if x[i] and x[j] and x[k]:
                            out[x[i], x[j], x[k]] = out.get((x[i], x[j], x[k]), 0) + toxicity.DECAY ** (k - i + 1)
                            norm += toxicity.DECAY ** (2 * (k - i + 1))
            return out, norm
        (p, n), (q, m) = phi(a), phi(b)
        return sum(c * q.get(t, 0) for t, c in p.items()) / math.sqrt(n * m)
    k = toxicity.kernel(strings, marks)
    assert all(k[i, j] == pytest.approx(brute(a, b)) for i, a in enumerate(strings) for j, b in enumerate(marks))


def test_text_margin_is_the_largest_of_all_windows():
    rng = random.Random(0)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", " ", ",", "!"]) for _ in range(rng.randrange(80))) for _ in range(60)]
    texts += ["", "...", "a", "é ü l o s e r x" * 3, "x" * 100 + " y", "anananananan ananananan", "\n\n a \t b \n"]
    w = np.random.default_rng(1).normal(size=(64, 64, 64)) * 0.3
    w[0] = w[:, 0] = w[:, :, 0] = 0
    for bias in (-0.8, 0.0):
        model = toxicity.Model(w.ravel(), bias)
        want = [max([*model.margins(toxicity.pieces(t)), bias - 1]) for t in texts]
        assert np.abs(model.text_margins(texts) - want).max() < 1e-9
        assert np.abs(np.concatenate([model.text_margins([t]) for t in texts]) - want).max() < 1e-9


def test_windows_hold_short_words_and_cross_blanks():
    got = set(toxicity.pieces("Shut up, and go die"))
    assert set(windows("shut", "up", "go die", "shut up, and", "up, and go")) <= got
    assert toxicity.piece("id io t") in toxicity.pieces("you are id io t here")
    assert toxicity.piece("loser") in toxicity.pieces("you l o s e r, no")
    assert all(len(p) <= toxicity.WIDTH for p in toxicity.pieces("x" * 200 + " a b"))
    h = lambda t: (lambda own: {bytes(own.c[i:j].astype(np.uint8)): x for i, j, x in zip(*own.windows()[:2], toxicity._hashes(own.c, *own.windows()[:2]))})(
        toxicity.layout([t]))
    one, two = h("some words go die here " * 3), h("go die, other some words")
    assert one[toxicity.piece("go die")] == two[toxicity.piece("go die")] and len(set(one.values())) == len(one)


def test_toxicity_learns_and_generalises(spark, nothing):
    rng = random.Random(1)
    syll = ["an", "der", "ti", "on", "re", "sh", "ea", "the", "in", "wh"]
    insults = ["loser", "idiot", "scumbag", "moron", "shut up", "go die", "kill yourself"]
    split = {"idiot": "id io t", "scumbag": "scum ba g", "loser": "lo se r"}
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.randint(1, 4)))
    docs, labels, tricky = [], [], set()
    for i in range(1500):
        w = [rng.choice(["shut", "up", "go", "kill", "to"]) if rng.random() < 0.1 else word() for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            s = rng.choice(insults)
            held = zlib.crc32(str(i).encode()) % 5 == 0
            w.insert(rng.randrange(len(w)), (split.get(s, s) if i % 3 else ".".join(s)) if held else s)
            tricky |= {i} if held and s not in ("idiot", "scumbag", "loser", "moron") or held and s in split and i % 3 else set()
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs += [(2000, None), (2001, ""), (None, "text"), (2002, "... !"), (0, docs[0][1])]
    labels += [(0, 1), (None, 1), (2000, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("toxic", F.lit(9))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.scored(d, lab, queries.crc_mod(5) != 0).toPandas()
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    held = got[got.held_out & got.doc_id.between(0, 1499)]
    assert (held.held_out == held.doc_id.map(lambda x: zlib.crc32(str(int(x)).encode()) % 5 == 0)).all()
    assert ((held.doc_id % 4 == 0) == (held.predicted == 1)).mean() > 0.97
    hard = held[held.doc_id.isin(tricky)]  # several words, or one broken up by blanks
    assert len(hard) > 30 and (hard.predicted == 1).mean() > 0.9
    assert (got[got.doc_id.isin([2000, 2001, 2002])].predicted == 0).all()
    assert toxicity.scored(nothing, lab, queries.crc_mod(5) != 0).count() == 0
    assert (toxicity.scored(d, lab.filter("1 = 0"), queries.crc_mod(5) != 0).toPandas().predicted == 0).all()


# --- 7: language -------------------------------------------------------------

def test_kneser_ney_sums_to_one():
    words = ["the", "then", "there", "hat", "that"]
    cp, off = langid._codes(words)
    g, n = np.unique(langid._grams(cp, off), return_counts=True)
    model = langid.kneser_ney(g, n)
    for ctx in (g >> langid.BITS)[:6].tolist() + [(5 << 2 * langid.BITS) | (6 << langid.BITS) | 7]:
        q = (ctx << langid.BITS) | np.arange(1 << langid.BITS)
        assert np.exp(model.score(q)).sum() == pytest.approx(1.0, abs=1e-6)


def test_language_held_out(documents, spark, awkward, nothing):
    got = langid.identify(documents, queries.crc_mod(4) != 2).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()
    odd = awkward.drop("lang").withColumn("lang", F.when(F.col("doc_id") < 9, "en").when(F.col("doc_id") == 11, "fr"))
    out = langid.identify(odd, F.lit(True)).toPandas()
    assert len(out) == awkward.count()
    assert set(out[out.doc_id.isin([1, 2, 8])].lang_pred) == {"und"} and set(out.lang_pred) <= {"en", "fr", "und"}
    assert langid.identify(nothing.withColumn("lang", F.lit("en")), F.lit(True)).count() == 0
    none = langid.identify(odd.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).toPandas()
    assert set(none.lang_pred) == {"und"}


def test_language_keeps_every_ngram(spark):
    letters = [chr(c) for c in range(0x400, 0x480) if chr(c).islower()] + [chr(c) for c in range(0x561, 0x587)] + [
        chr(c) for c in range(0xE0, 0x250) if chr(c).islower()]
    text = " ".join(a + b + c for a in letters[:60] for b in letters[60:140] for c in letters[140:210])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    counts = langid.ngram_counts(df, F.lit("x"))
    assert counts.count() > 600_000
    assert len(langid.train(counts)["x"].grams[-1]) == counts.count()


def test_language_model_of_any_size(spark, documents, awkward, monkeypatch):
    docs = documents.select("doc_id", "text", "lang").limit(60).unionByName(awkward.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    key = lambda r: (str(r.doc_id), r.held_out, r.lang_pred, r.rejected, round(r.score, 6), round(r.cross_entropy or 0, 6))
    want = sorted(key(r) for r in langid.identify(docs, queries.crc_mod(4) != 2).collect())
    monkeypatch.setattr(langid, "MODEL_GRAMS", 0)
    assert sorted(key(r) for r in langid.identify(docs, queries.crc_mod(4) != 2).collect()) == want


# --- 8: BPE ------------------------------------------------------------------

@pytest.mark.parametrize("block", [1, 32 << 20])
def test_bpe_equals_library(awkward, documents, block):
    t = Tokenizer.from_file(TOKENIZER)
    for df in (awkward, documents.limit(60)):
        want = []
        for i, text in rows(df):
            ids = t.encode(text, add_special_tokens=False).ids
            want.append((i, len(ids), ids, t.decode(ids, skip_special_tokens=False)))
        got = [tuple(r) for r in bpe.encode_decode(df, TOKENIZER, block_chars=block).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        dig = [tuple(r) for r in bpe.encode_decode(df, TOKENIZER, digests=True).collect()]
        assert sorted(dig, key=str) == sorted(((i, n, sha(" ".join(map(str, x))), sha(d)) for i, n, x, d in want), key=str)


def test_bpe_odd_characters_and_empty(spark, nothing):
    t = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(4)
    alphabet = "aZé'sß ͅΣσς İıǅ½²٣中か́한​\x1c\x85\xa0\t\n😀¡¿«" + "'ll've1."
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_decode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), TOKENIZER).collect()}
    for i, x in enumerate(texts):
        assert got[i] == t.encode(x, add_special_tokens=False).ids, repr(x)
    assert bpe.encode_decode(nothing, TOKENIZER).count() == 0


# --- 9: repeats --------------------------------------------------------------

def brute_repeats(texts, length):
    data = [t.encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((len(d), int(gone.sum()), int((edge == 1).sum()), bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("group_rows", [20_000, 2])
def test_repeats_equal_brute_force(spark, group_rows):
    rng = random.Random(8)
    for alphabet in ("ab", "abcdefghijklmnopqrstuvwxyz é"):
        base = "".join(rng.choice(alphabet) for _ in range(300))
        texts = [None, "", "ab" * 60, "a" * 90, "\x00" * 70, "é" * 40, base, base]
        for _ in range(25):
            a = rng.randrange(200)
            texts.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) + base[a:a + rng.randrange(90)]
                         + "".join(rng.choice(alphabet) for _ in range(rng.randrange(30))))
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("tid", F.lit(1))
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
               for r in suffix_dedup.remove_repeats(df, 24, 8, group_rows).collect()}
        want = brute_repeats([t or "" for t in texts], 24)
        assert [got[i] for i in range(len(texts))] == want


def test_maximal_repeats_list_all_occurrences():
    texts = [b"xxHELLOWORLDyy", b"zzHELLOWORLDqq", b"__HELLOWORLD--", b"unrelated text"]
    n = len(texts)
    left, right = np.zeros((n, 2), np.uint8), np.zeros((n, 12), np.uint8)
    for i, t in enumerate(texts):
        left[i], right[i] = list(t[:2][::-1]), list(t[2:14].ljust(12, b"\0"))
    lens = np.full(n, 2), np.full(n, 12)
    row, a, b, number = suffix_dedup.repeats(np.zeros(n, np.uint64), left, lens[0], right, lens[1], length=10, gram=4)
    assert sorted(row.tolist()) == [0, 1, 2] and set(b) == {10} and set(a) == {0} and len(set(number)) == 1


def test_repeats_awkward(awkward, nothing):
    got = suffix_dedup.remove_repeats(awkward, digests=True)
    assert got.count() == awkward.count() and suffix_dedup.remove_repeats(nothing).count() == 0
    whole = {r["doc_id"] for r in got.filter("n_removed = n_bytes and n_bytes > 0").collect()}
    assert {3, 4, 5, 6, 14} <= whole


# --- 10: n-gram join ---------------------------------------------------------

@pytest.mark.parametrize("block_rows", [512, 3])
def test_join_equals_brute_force(spark, block_rows):
    rng = random.Random(12)
    docs = {}
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 40, 120, 300]))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
            docs[len(docs)] = rng.choice([" ", ", ", "\n"]).join(w)
    docs |= {1000: "", 1001: "...", 1002: "", 1003: "one two", 1004: "One, two!"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.join_classes(df, block_rows=block_rows).collect()}
    assert got == ngram_join.exact_join(docs)
    kept = ngram_join.one_per_class(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in ngram_join.exact_join(docs).values()})


def test_posterior_pruning_keeps_similar_pairs():
    least = ngram_join.least_matches()
    rng = np.random.default_rng(2)
    lost = sum(any(m < k for m, k in zip(np.cumsum(rng.random(ngram_join.HASHES) < 0.8)[ngram_join.STEP - 1::ngram_join.STEP], least, strict=True))
               for _ in range(20_000))
    assert lost <= 40 and all(a <= b for a, b in zip(least, least[1:], strict=False))


@pytest.mark.parametrize("similarity", [0.8, 0.81, 0.82, 0.85])
def test_pruning_loses_less_than_the_bands(similarity):
    step = [math.comb(ngram_join.STEP, k) * similarity ** k * (1 - similarity) ** (ngram_join.STEP - k) for k in range(ngram_join.STEP + 1)]
    held, lost = np.ones(1), 0.0
    for least in ngram_join.least_matches():
        held = np.convolve(held, step)
        lost += held[:least].sum()
        held[:least] = 0
    assert lost <= 1e-7


def test_join_awkward(awkward, nothing):
    got = ngram_join.join_classes(awkward)
    assert got.count() == awkward.count()
    by = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in got.filter("doc_id is not null").collect()}
    assert by[4] == (3, 2) and by[6][0] == 5 and by[9] == (9, 2) and by[10] == (9, 2) and by[2][0] == 1
    kept = ngram_join.one_per_class(awkward)
    assert kept.columns == awkward.columns and kept.filter("doc_id in (3, 4, 5, 6, 9, 10)").count() == 3
    assert ngram_join.join_classes(nothing).count() == 0 and ngram_join.one_per_class(nothing).count() == 0


# --- SQL ---------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duck(SMALL)
    got = queries.queries()[name](spark, SMALL).toPandas().astype(object)
    want = con.execute(queries.oracle_sql()[name]).fetchdf().astype(object)
    clean = lambda x: frame_rows(x.where(x.notna(), None))
    assert clean(got) == clean(want)
