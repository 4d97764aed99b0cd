"""Decontamination, BPE, token counts, quality and language against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from skyhealth.llm import bpe, decontaminate, language, quality, token_counts

from .conftest import ODD

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def plain_hits(text, items):
    words = WORD.findall((text or "").encode().translate(LOWER))
    hit, found = set(), set()
    for item_id, item in items:
        own = WORD.findall((item or "").encode().translate(LOWER))
        size = min(13, len(own))
        grams = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i:i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(str(item_id) if item_id is not None else "")
    ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), ids, len(hit) > 0 and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block_bytes", [8 << 20, 40])
def test_decontamination(spark, docs_of, block_bytes):
    words = [f"w{i}" for i in range(60)]
    items = [(1, " ".join(words[:20])), (2, "Short ITEM"), (3, None), (4, ""), (None, " ".join(words[30:44])), (2, "short item"),
             (5, " ".join(words[5:25]))]
    rows = ODD + [(20, "pre " * 30 + " ".join(words[3:17]) + " post"), (21, "a short, Item!"), (22, " ".join(words)),
                  (23, " ".join(words[:12])), (24, "x " * 500 + "short item")]
    got = decontaminate.judge(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"), ["doc_id", "text"],
                              block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == plain_hits(r.text, items)


def test_decontamination_stage_keeps_clean_rows_and_columns(spark, docs_of, odd, no_docs):
    items = spark.createDataFrame([(1, "the end the end the end the end the end the end the")], "item_id long, text string")
    kept = decontaminate.remove(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == len(ODD) - 1
    assert decontaminate.remove(no_docs, items).count() == 0
    assert decontaminate.remove(odd, items.limit(0)).count() == len(ODD)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_path()),
                             special_tokens={})


def plain_offsets(tik, text):
    """First and end character of each token, byte by byte."""
    char = [i for i, c in enumerate(text) for _ in c.encode()]
    out, at = [], 0
    for token in tik.decode_tokens_bytes(tik.encode_ordinary(text)):
        out.append((char[at], char[at + len(token) - 1] + 1))
        at += len(token)
    return out


def test_bpe_keeps_columns_of_its_own_names(spark):
    docs = spark.createDataFrame([("a b", 1, 2)], "text string, ids int, decoded int")
    row = bpe.decode(bpe.encode(docs)).first()
    assert (row.ids_input, row.decoded_input, bytes(row.decoded)) == (1, 2, b"a b")


def test_bpe_is_tiktokens_and_comes_back(docs_of, tik, sample_docs):
    odd = ODD + [(30, "<|endoftext|> it's\r\n  \x1c\x85 ١٢ ab=====" + " " * 70 + "é́漢字🙂"), (31, "aaa" * 99)]
    for docs, keep in ((docs_of(odd), ["doc_id", "text"]), (sample_docs, ["doc_id", "text"])):
        for r in bpe.digests(docs, keep, with_ids=True).collect():
            ids = tik.encode_ordinary(r.text or "")
            assert r.ids == ids and r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
            assert r.offsets_sha256 == hashlib.sha256(np.array(plain_offsets(tik, r.text or ""), "<i4").tobytes()).hexdigest()


def test_bpe_offsets_and_decode(docs_of, no_docs):
    text = "It's a café — 🙂 naïve"
    row = bpe.round_trips(bpe.decode(bpe.encode(docs_of([(1, text)]), offsets=True))).first()
    assert row.same and bytes(row.decoded).decode() == text
    assert row.starts[0] == 0 and row.ends[-1] == len(text)
    assert all(a <= b for a, b in zip(row.starts, row.ends)) and set(range(len(text))) == {
        i for a, b in zip(row.starts, row.ends) for i in range(a, b)}
    assert bpe.encode(no_docs).count() == 0


#: Whitespace in and beyond ASCII, letters that end in the same bytes, quotes, signs.
AWKWARD = ["a", "b", "Z", "'", "'s", "'re", ".", ",", "1", "\0", "\n", "\t", "\r", "\x1c", "\x1f", "\x85", "\xa0", "é", "à",
           "漢", "\u2003", "\u200b", "\u3000", "\u1680", "я", "e\u0301", "🙂", "١"] + [" "] * 6


@pytest.mark.parametrize("window, kept", [(7, 3), (64, 10), (1 << 21, 100_000)])
def test_bpe_cuts_nothing_the_pattern_joins(tik, monkeypatch, window, kept):
    monkeypatch.setattr(bpe, "WINDOW_BYTES", window)
    monkeypatch.setattr(bpe, "KNOWN_STRINGS", kept)
    draw = random.Random(9)
    own = bpe.Codec(bpe.default_path())
    for _ in range(4):
        texts = [None, "", *("".join(draw.choices(AWKWARD, k=draw.randrange(60))) for _ in range(400)), "漢字" * 40, ""]
        ids, at = own.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [tik.encode_ordinary(t or "") for t in texts]
        assert own.decode(ids).tobytes() == "".join(t or "" for t in texts).encode()


def test_bpe_splits_each_distinct_string_once():
    own, seen = bpe.Codec(bpe.default_path()), []
    split = own.pieces
    own.pieces = lambda text: seen.append(text) or split(text)
    line = "It's the 2nd café, at noon. "
    for _ in range(2):
        own.encode(pa.array([line * 200] * 20))
    assert len(seen) == len(set(seen)) and sum(map(len, seen)) <= 2 * len(line)


def test_bpe_decodes_null_and_empty_ids(spark):
    rows = spark.createDataFrame([(1, [64, 65]), (2, None), (3, []), (4, [66])], "doc_id long, ids array<int>").coalesce(1)
    ranks = {r: t for t, r in bpe.read_ranks(bpe.default_path()).items()}
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(rows).collect()} == {
        1: ranks[64] + ranks[65], 2: b"", 3: b"", 4: ranks[66]}


@pytest.mark.parametrize("block_tokens", [7, 64, 1 << 18])
def test_token_counts_match_encoding(docs_of, tik, block_tokens):
    # With many small blocks, one shorter very long text.
    rows = [(i, t[:3000] if t and block_tokens < 1000 else t) for i, t in ODD]
    got = token_counts.of_documents(docs_of(rows).coalesce(2), block_tokens=block_tokens).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len(tik.encode_ordinary(t or ""))) for i, t in rows)
    for f in {r.file_id for r in got}:
        own = sorted(r.doc_no for r in got if r.file_id == f)
        assert own == list(range(len(own)))


def test_token_counts_of_no_documents(no_docs):
    assert token_counts.of_documents(no_docs).count() == 0


def test_token_counts_of_a_file_over_two_gigabytes(spark, tmp_path):
    size = (1 << 31) + 4_000_000
    with open(tmp_path / "large file", "wb") as f:  # sparse
        for at in (10, 1 << 31, size - 2):
            f.seek(at)
            f.write(np.array([token_counts.END_OF_DOCUMENT], "<u2").tobytes())
    got = token_counts.count(token_counts.read_files(spark, str(tmp_path), block_tokens=1 << 22)).orderBy("doc_no").collect()
    assert [(r.doc_no, r.n_tokens) for r in got] == [(0, 5), (1, (1 << 30) - 6), (2, 2_000_000 - 2)]


def test_token_blocks_keep_columns_of_their_own_names(spark):
    blocks = spark.createDataFrame([(1, 0, bytearray(b"\x01\x00"), 5, "p")], "file_id long, block_no long, tokens binary, n_sep int, pieces string")
    row = token_counts.scan_blocks(blocks).first()
    assert (row.n_sep_input, row.pieces_input, row.n_sep, row.pieces) == (5, "p", 0, [1])


def test_token_counts_of_real_files(spark, tmp_path):
    end = token_counts.END_OF_DOCUMENT
    files = {"a": [5] * 10 + [end, end] + [7] * 3, "b": [end], "c": [1] * 23 + [end] + [2] * 40 + [end], "d": []}
    for name, ids in files.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
    got = token_counts.count(token_counts.read_files(spark, str(tmp_path), block_tokens=8)).collect()
    seen = Counter()
    for f in {r.file_id for r in got}:
        seen[tuple(r.n_tokens for r in sorted((r for r in got if r.file_id == f), key=lambda r: r.doc_no))] += 1
    assert seen == {(10, 0, 3): 1, (0,): 1, (23, 40): 1}


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    cover = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover),
            n < 50 or 100 * len(cover) > 50 * n)


def test_quality_counts(odd, no_docs, sample_docs):
    for docs, n in ((odd, len(ODD)), (sample_docs, sample_docs.count())):
        rows = quality.judge(docs.withColumnRenamed("row", "n_words") if "row" in docs.columns else docs).collect()
        texts = docs.select("doc_id", "text").collect()
        assert len(rows) == n
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                      for r in rows) == sorted((str(t.doc_id), *plain_quality(t.text)) for t in texts)
    assert quality.judge(no_docs).count() == 0


def test_quality_line_rules(docs_of):
    prose = "\n".join(f"Sentence{i} has{i} plain{i} different words{i} in it{i}." for i in range(12))
    bad = ["Home | About | News | More.", "COOKIE settings here.", "Todos los derechos reservados.", "Alle Rechte vorbehalten.",
           "(Tous droits réservés.)", "Under the Apache-2 licence.", "LOUD WORDS ARE HERE.", "no end mark in this line",
           "a### b$$$ c%%% d&&&."]
    clean, mixed = quality.judge(docs_of([(1, prose), (2, prose + "\n" + "\n".join(bad))])).orderBy("doc_id").collect()
    assert clean.kept and clean.text == prose
    assert mixed.kept and mixed.text == prose
    assert not quality.judge(docs_of([(3, "\n".join(f"Home | Page{i} | b{i} | c{i} | d{i}." for i in range(40)))])).first().kept


def test_language(spark, odd, no_docs, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert sum(got[i].lang_pred == truth[i] for i in held) / len(held) >= 0.98
    samples = language.learn(docs)
    rows = language.predict(odd, samples, ["text"]).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert 0 <= r.score <= 1
    kept = language.keep_identified(odd)
    assert kept.columns == odd.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in ODD)
    assert language.identify(no_docs).count() == 0
    assert {r.lang_pred for r in language.identify(docs_of([(i, "abc", None) for i in range(5)])).collect()} == {"und"}


def plain_phrases(text, sample):
    n, i = 0, 0
    while i < len(text):
        size = 1
        while i + size < len(text) and text[i:i + size + 1] in sample:
            size += 1
        n, i = n + 1, i + size
    return n


def test_phrases_are_the_longest_matches():
    own = language.Model((("a", b"abracadabra banana"),))
    for text in (b"abra", b"abracadabra", b"banabra", b"zzz", b"anancadx bana", b"a"):
        assert own.phrases([text])[0, 0] == plain_phrases(text, b"abracadabra banana"), text


@pytest.mark.parametrize("block", [1, 5, 64, language.BLOCK])
def test_phrases_run_on_over_blocks(monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK", block)
    rnd = np.random.default_rng(7)
    samples = (("a", bytes(rnd.choice(list(b"abc "), 400).tolist())), ("b", b"ab" * 150), ("c", b"x"))
    texts = [bytes(rnd.choice(list(b"abc d"), n).tolist()) for n in (0, 1, 4, 5, 6, 63, 64, 65, 700, 3000)]
    texts += [b"ab" * 1200, samples[0][1] * 8, b"", samples[0][1][100:390] * 5, b"a", b"x" * 2049]
    got = language.Model(samples).phrases(texts)
    assert got.tolist() == [[plain_phrases(t, s) for _, s in samples] for t in texts]


def test_language_of_a_text_is_that_of_fewest_phrases(spark, docs_of, sample_docs):
    samples = language.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 2000)
    texts = [r.text for r in sample_docs.select("text").limit(40).collect()]
    rows = [(i, t) for i, t in enumerate([*texts, " ".join(texts), "é", "x" * 5000, texts[0] * 20])]
    for r in language.predict(docs_of(rows), samples, ["text"]).collect():
        words = re.sub(rb"[^a-z\x80-\xff]+", b" ", r.text.lower().encode()).strip()
        cost = sorted((plain_phrases(words, s) * math.log2(len(s)), name) for name, s in samples)
        assert r.lang_pred == cost[0][1]
        assert r.score == pytest.approx(cost[1][0] / (cost[0][0] + cost[1][0]))


def test_decontamination_blocks_are_bounded(spark):
    rows = [(str(i), " ".join(f"w{i}x{j}" for j in range(i % 50))) for i in range(400)] + [("900", "long " * 500), ("901", None)]
    items = spark.createDataFrame(rows, "item_id string, text string").where("text IS NOT NULL")
    blocks = list(decontaminate.benchmark_blocks(items, 2_000))
    assert len(blocks) > 20 and sorted(x for b in blocks for x, _ in b) == sorted(i for i, t in rows if t is not None)
    assert max(sum(len(t) for _, t in b) for b in blocks) <= max(2 * 2_000, 2_500 + 2_000)
