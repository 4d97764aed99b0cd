"""Vector codes, privacy and divergence against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyhealth.llm import divergence, privacy, vector_codes

from .conftest import ODD

# --- vector codes ------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, code string, v int"


def plain_codes(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label, *_ in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0], kept[r][1]))[:entries]
    books = [[cut[r][p] for r in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for c in cut:
                own[nearest(c[p], books[p])[1]].append(c[p])
            for k, xs in own.items():
                books[p][k] = [sum(x) // len(xs) for x in zip(*xs)]
    out, by_label = [], Counter()
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((*r, by_label[r[3]], hashlib.sha256(flat.encode()).hexdigest()) for r in out), key=str)


def test_vector_codes(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 32).astype(np.float32)], int(i % 3) or None, "x", 1) for i in range(150)]
    rows += [(200 + i, rows[7][1], 1, "x", 1) for i in range(40)] + [rows[3]]
    rows += [(300, [0.0] * 32, 2, "x", 1), (301, None, 2, "x", 1), (302, [math.nan] + [0.0] * 31, 2, "x", 1),
             (303, [None] + [0.0] * 31, 2, "x", 1), (304, [math.inf] * 32, 2, "x", 1), (305, [], 2, "x", 1)]
    got = vector_codes.compress(spark.createDataFrame(rows, VECTORS).repartition(5))
    out = [(r.vec_id, r.code, r.error, r.label, r.label_error, r.codebooks_sha256) for r in got.collect()]
    assert sorted(out, key=str) == plain_codes(rows, 16, 64, 2)


def test_vector_codes_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_codes.compress(empty).count() == 0
    rows = [(None, [0.5] * 16, 1, "x", 1), (2, [0.25] * 16, None, "x", 1), (3, [0.25] * 17, 1, "x", 1), (4, [1e30] * 16, 1, "x", 1)]
    got = {r.vec_id: r for r in vector_codes.compress(spark.createDataFrame(rows, VECTORS)).collect()}
    assert set(got) == {None, 2} and got[2].code == "00" * 16 and got[2].error == got[2].label_error
    lost = spark.createDataFrame([(None, [0.5] * 5, 1, "x", 1), (None, [0.5] * 5, 1, "x", 1)], VECTORS)
    assert [(r.error, r.code) for r in vector_codes.compress(lost).collect()] == [(0, "00" * 16)] * 2


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_equal_average_search_is_exact(spread):
    rng = np.random.default_rng(spread)
    entries, x = rng.integers(-spread, spread + 1, (40, 4)), rng.integers(-spread, spread + 1, (500, 4))
    index, d = vector_codes.Codebook(entries).nearest(x)
    full = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()


# --- divergence --------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_audit(rows, min_docs):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    df, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        df[lang].update(set(words))
        n[lang, source].update(words)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, c in df[lang].items() if c >= min_docs]
        groups = sorted({s for g, s, _ in docs if g == lang})
        total = {s: sum(n[lang, s][t] for t in kept) for s in groups}

        def p(count, whole, kept=kept):
            return 1 + 10 ** 9 * (count + 2) // (whole + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in groups:
            pairs = [(sum(f(p(n[lang, s][t], total[s]), p(n[lang, o][t], total[o])) for t in kept), o) for o in groups if o != s]
            terms = []
            for t in kept:
                own, all_ = p(n[lang, s][t], total[s]), p(sum(n[lang, o][t] for o in groups), sum(total.values()))
                if n[lang, s][t] and own > all_:
                    terms.append((f(own, all_), t))
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < 10]
    return sorted(out)


@pytest.mark.parametrize("bucket_rows", [divergence.BUCKET_ROWS, 5])
def test_divergence(spark, bucket_rows, monkeypatch):
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in "abcdéç" for b in "xyzüñ"]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 30))), ["en", "fr", None][i % 3], f"s{i * i % 7}") for i in range(90)]
    rows += [(rows[0][0], "en", "s0")] * 20 + [("The THE the! end-of\x00it " * 2000, "en", None), (None, None, None), ("", "de", "a"), ("solo", "de", "b"),
                                               ("1 2 3", "it", "only")]
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "text string, lang string, source string, term int, part string, bucket string")
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    got = divergence.audit(docs.repartition(4), min_docs=5, bucket_rows=bucket_rows)
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, 5)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_equal_subtrees_are_one_node():
    term = np.arange(64)
    forest = divergence.Forest(2, 64, np.r_[np.zeros(64, int), np.ones(64, int)], np.r_[term, term], np.r_[term % 2 + 1, term % 2 + 1])
    assert forest.root[0] == forest.root[1] and all(len(left) == 2 for left, _ in forest.children)
    pair, x, y, times = forest.walk(np.array([0]), np.array([1]))
    assert sorted(times.tolist()) == [32, 32]


def test_divergence_counts_beyond_64_bits():
    forest = divergence.Forest(1, 1, np.array([0]), np.array([0]), np.array([10 ** 15]))
    assert divergence.shares(forest, np.array([0]), np.array([1]), np.array([4 * 10 ** 15])).tolist() == [250_000_001]


# --- privacy -----------------------------------------------------------------

def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]


def plain_base(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, p, ok in PLAIN for m in re.finditer(p, text or "") if ok(m[0])]


HARD = ["a@b.c._x@d.e and x@y..z @q.r a.b@c", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.01.1.1 1.2.3", "4465758382889437 4465-7583-8288-9437 44657583828894371",
        "4465758382889437  4465 7583 8288 9437-1", "+1 (743) 555-3824 +12 +1 2 3 4 5 6 7 8 +1((((( +49.30.1234567.", "é🙂 mail 🙂 ü@x.yz ñ.o@p.q 🙂1.2.3.4",
        "x" * 50_000, "1" * 50_000, "1." * 30_000, "a@" * 20_000, "1 " * 30_000, "+1" * 20_000, "a@b.c " * 700 + "9"]


def test_base_patterns(docs_of, no_docs):
    rng = np.random.default_rng(1)
    texts = HARD + ["".join(rng.choice(list("a1.@+- (0é9"), 60)) for _ in range(300)] + ["".join(rng.choice(list("45678 -"), 40)) for _ in range(200)]
    rows = ODD + [(100 + i, t) for i, t in enumerate(texts)]
    got = privacy.find(docs_of(rows), ["doc_id", "text"]).select("row.text", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans").collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_base(r.text)
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in privacy.BASE] == want, (r.text or "")[:80]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(f"{k}:") for s in want) for k in privacy.BASE]
    assert privacy.find(no_docs, ["doc_id"]).count() == 0
    assert privacy.sanitise(no_docs).count() == 0


def test_terms_that_disclose(docs_of):
    # Quillfeather is near the address in all its documents; "the" and "office" are everywhere.
    mail = "the office of Quillfeather, the Zebrafish, a.b@c.de, the office"
    rows = [(i, f"{mail} {i}") for i in range(5)] + [(10 + i, "the office of zebrawood is open") for i in range(100)]
    rows += [(200, "Call the office +1 (743) 555-3824 now")]
    docs = docs_of(rows)
    got = {r.doc_id: r.spans for r in privacy.find(docs, ["doc_id"]).select("row.doc_id", "spans").collect()}
    at, z = mail.index("Quillfeather"), mail.index("Zebrafish")
    mail_at = mail.index("a.b@")
    assert got[0] == f"email:{mail_at}:{mail_at + 8},general:{z}:{z + 9},remove:{at}:{at + 12}"
    # One document is no evidence; documents without an entity stay as they are.
    assert got[200] == "phone:16:33" and got[10] == ""
    clean = {r.doc_id: r for r in privacy.sanitise(docs).collect()}
    assert clean[0].text == "the office of [TERM], the Zeb*, [EMAIL], the office 0"
    assert clean[10].text == rows[5][1] and clean[10].asDict().keys() == set(docs.columns)


def test_sanitise_odd_rows(odd):
    assert sorted(map(str, privacy.sanitise(odd).select("doc_id", "text").collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))


def test_overlapping_spans_are_rewritten_once(docs_of):
    text = "x +4222222222222 y"
    (r,) = privacy.sanitise(docs_of([(1, text + " 5"), (2, "none")])).where("doc_id = 1").collect()
    assert r.text == "x [PHONE] y 5"


def test_prefix_sums_in_blocks(spark):
    n = 1000
    (r,) = spark.range(1).select(privacy.before_each(F.sequence(F.lit(1), F.lit(n))).alias("s")).collect()
    assert r.s == [i * (i + 1) // 2 for i in range(n)]
