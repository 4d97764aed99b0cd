"""Suffix dedup, SimHash, chat, sharding, scores and the pipeline against
brute-force versions."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash

from skyhealth.llm import chat, common, components, context_tree, sharding, simhash, suffix_dedup

from .conftest import ODD


def plain_dedup(rows, depth=100):
    """rows: (doc_id, text); the result in the same order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), {}
    for i in order:
        text = (rows[i][1] or "").encode()
        gone, fresh = np.zeros(len(text), bool), []
        for p in range(len(text) - depth + 1):
            g = text[p:p + depth]
            if g in seen:
                gone[p:p + depth] = True
            seen.add(g)
        left = bytes(b for b, x in zip(text, gone) if not x)
        spans = int(np.sum(np.diff(np.r_[0, gone.astype(int)]) == 1))
        out[i] = (len(text), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return [out[i] for i in range(len(rows))]


def check_dedup(docs_of, rows, **how):
    rows = [r[:2] for r in rows]
    got = suffix_dedup.dedup(docs_of(rows), **how).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got)) == sorted(key((r[0], *d)) for r, d in zip(rows, plain_dedup(rows)))


def test_suffix_dedup_odd(docs_of):
    check_dedup(docs_of, [r for r in ODD if r[0] != 8] + [(8, "The end.\n" * 300)])


@pytest.mark.parametrize("most_runs", [suffix_dedup.MOST_RUNS, 1])
def test_suffix_dedup_random(docs_of, most_runs):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    passages = [" ".join(rnd.choice(words) for _ in range(rnd.randint(15, 60))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rnd.choice(passages)[rnd.randint(0, 20):] if rnd.random() < .5 else
                 " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 80))) for _ in range(rnd.randint(1, 4))]
        rows.append((rnd.randint(0, 50), rnd.choice([" ", ""]).join(parts)))
    rows += [(99, "ab" * 400), (98, "ab" * 90), (97, "a" * 500), (97, "a" * 500), (96, "b" + "a" * 120)]
    check_dedup(docs_of, rows, most_runs=most_runs)


def test_suffix_dedup_one_passage_in_many_contexts(docs_of, spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9)))
    passage = " ".join(word() for _ in range(25))
    rows = [(i, " ".join([word() for _ in range(9)] + [passage] + [word() for _ in range(9)])) for i in range(300)]
    # Small batches, so that the passage's runs come to a task in parts.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        check_dedup(docs_of, rows, most_runs=30)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_suffix_dedup_rows_of_nobody(docs_of):
    copy = "".join(random.Random(9).choice("abcdef ") for _ in range(400))
    texts = [copy, copy, "x" + copy, copy[50:], "short"]
    got = suffix_dedup.dedup(docs_of([(None, t) for t in texts] + [(1, copy)])).collect()
    assert sum(r.n_bytes - r.n_removed for r in got) < 400 + 100 + 5 + 100
    assert next(r for r in got if r.row.doc_id == 1).n_removed == 400


def test_by_key_in_parts():
    import pyarrow as pa

    rows = [1] + [2] * 7 + [3, 4, 4] + [5] * 12 + [6]
    batches = [pa.RecordBatch.from_pydict({"g": pa.array(rows[i:i + 3])}) for i in range(0, len(rows), 3)]
    got = [(list(c["g"]), large) for c, large in common.by_key_in_parts(iter(batches), "g", ["g"], 4)]
    assert [x for part, _ in got for x in part] == rows
    for value, large in ((1, False), (2, True), (3, False), (4, False), (5, True), (6, False)):
        assert {m for part, m in got if value in part} == {large}
        assert large or sum(value in part for part, _ in got) == 1


def test_suffix_dedup_long_text(docs_of):
    rnd = random.Random(4)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(2500))
    check_dedup(docs_of, [(1, part + "x" * 50 + part[300:1900]), (2, part[1000:] + "tail"), (3, "z" * 30 + part[:1500])], piece=1000)


def test_suffix_dedup_stage(odd, no_docs):
    kept = suffix_dedup.cleaned(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    assert suffix_dedup.dedup(no_docs).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().translate(context_tree.ASCII_LOWER).split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=3):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            root[find(a)] = find(b)
    names = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        names[find(i)].append(doc_id)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in names.items()}
    return [(f"{fps[i]:016x}", least[find(i)]) for i in range(len(rows))]


def test_simhash(docs_of, sample_docs, no_docs):
    rows = [tuple(r) for r in sample_docs.select("doc_id", "text").collect()] + [(500 + i if i else None, t) for i, t, *_ in ODD]
    got = simhash.near_duplicates(docs_of(rows), ["doc_id"]).collect()
    want = plain_components(rows)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter((r[0], *w) for r, w in zip(rows, want))
    kept = simhash.keep_first(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({w[1] for w in want})
    assert simhash.keep_first(no_docs).count() == 0


@pytest.mark.parametrize("parts", [[(0xFFFF << s, 0) for s in (0, 16, 32, 48)], [(0xFFFFFFFF, 1), (0xFFFFFFFF << 32, 1)],
                                   [((1 << 22) - 1, 1), (((1 << 21) - 1) << 22, 0), (((1 << 21) - 1) << 43, 0)]])
def test_simhash_links_are_complete(spark, parts):
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for _ in range(5):
            fps.add(f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4))))
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    got = {(r.a, r.b) for r in simhash.links(frame, parts).collect()}
    assert got == {tuple(sorted((simhash.signed(a), simhash.signed(b)))) for a, b in itertools.combinations(fps, 2)
                   if (a ^ b).bit_count() <= 3}


def test_simhash_plan_spends_the_whole_allowance():
    rnd = np.random.default_rng(0)
    sample = rnd.integers(0, 2**63, 300, dtype=np.uint64)
    seen = set()
    for n in (10, 10**5, 10**7, 10**9, 10**11):
        chosen = simhash.plan(sample, n)
        masks = [m for m, _ in chosen]
        assert all(a & b == 0 for a, b in itertools.combinations(masks, 2))
        assert sum(t + 1 for _, t in chosen) == simhash.MAX_BITS + 1
        seen.add(tuple(t for _, t in chosen))
    assert len(seen) > 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, i) for i in range(6, 40)] + [(7, 300), (301, 300)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 200 for i in range(200, 261))
    assert all(got[i] == 5 for i in [*range(5, 40), 300, 301])


def test_chat(spark):
    rows = []

    def say(conv, turns, first=0):
        rows.extend((conv, first + i, r, t) for i, (r, t) in enumerate(turns))

    long = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", None)]
    for k in range(1, 5):
        say(k, long[:k])
    say(5, long)                                     # equal to 4
    say(6, [("user", "a"), ("assistant", "B")])
    say(7, [("user", "a"), ("assistant", "b"), ("user", "")])
    say(8, long, first=510)                          # over a segment border
    say(None, [("user", "a")])
    rows += [(9, 0, "user", "a"), (9, 0, "user", "a"), (10, None, None, "x"), (10, 1, "user", "y"), (11, None, None, "x")]
    rows += [(12, 0, "user", "z" * 300_000), (12, 1, "assistant", "")]
    turns = spark.createDataFrame([(*r, 1, "x", None, 7) for r in rows], "conv_id long, turn long, role string, text string, "
                                  "segment int, rendered string, copies string, n_turns int")
    kept = {r.conv_id: (r.n_turns, r.copies) for r in chat.maximal(turns).collect()}
    assert kept == {4: (4, 2), 6: (2, 1), 7: (3, 1), 8: (4, 1), 9: (2, 1), 10: (2, 1), 12: (2, 1)}
    out = chat.format_chats(turns).collect()
    assert {(r.conv_id, r.segment) for r in out} >= {(8, 0), (8, 1), (4, 0)}
    assert next(r for r in out if r.conv_id == 12).rendered.count("z") == 300_000
    four = next(r for r in out if r.conv_id == 4)
    assert four.rendered == "<|user|>\na\n<|end|>\n<|assistant|>\nb\n<|end|>\n<|user|>\nc\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_chat_renders_a_crowded_turn_in_parts(spark):
    """Many rows of one turn number, or of none, are never one group."""
    rows = [(n, t, "user", f"{i:04d}") for n, t in ((1, 3), (2, None), (None, 0)) for i in range(1200)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(turns).collect()
    assert len(out) == 9
    for conv in (1, 2, None):
        parts = sorted((r.part, r.rendered) for r in out if r.conv_id == conv)
        assert [p for p, _ in parts] == [0, 1, 2]
        assert [t.count("<|user|>") for _, t in parts] == [512, 512, 176]
        assert "".join(t for _, t in parts) == "".join(f"<|user|>\n{i:04d}\n<|end|>\n" for i in range(1200))


@pytest.mark.parametrize("ranges", [4, 64])
def test_sharding(docs_of, no_docs, sample_docs, ranges):
    rows = [tuple(r) for r in sample_docs.select("doc_id", "text").collect()] + [(1000 + i, "hot copy " * 40) for i in range(300)] + [r[:2] for r in ODD]
    got = sharding.shard(docs_of(rows), ranges=ranges).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    together = defaultdict(set)
    for r in got:
        together[r.size, r.text_crc32, r.group_split].add(r.shard)
    assert all(len(shards) == 1 for (_, _, split), shards in together.items() if not split)
    assert {r.group_split for r in got if (r.doc_id or 0) >= 1000} == {True}
    whole = [r for r in rows if r[0] != 8]
    got = sharding.shard(docs_of(whole), ranges=ranges).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 16
    biggest = max(len((t or "").encode()) + 1 for _, t in whole)
    assert all(abs(sizes[s] - mean) <= mean / 20 + 2 * biggest for s in range(16))
    assert sharding.shard(no_docs).count() == 0


def plain_scores(rows, depth=context_tree.DEPTH):
    """Context-tree weighting, node by node."""
    low = [((t or "").encode().translate(context_tree.ASCII_LOWER)) for _, t in rows]
    learn = [i is None or zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def steps(text):
        padded = bytes(depth) + text + b"\0"
        for at in range(depth, len(padded)):
            yield padded[at - depth:at][::-1], padded[at]

    for text, use in zip(low, learn):
        for context, byte in steps(text) if use else ():
            for j in range(8):
                node = (1 << j) | byte >> (8 - j)
                for d in range(depth + 1):
                    counts[context[:d], node][byte >> (7 - j) & 1] += 1
                    if d:
                        children[context[:d - 1], node].add(context[:d])
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - 2 * math.lgamma(.5) - math.lgamma(a + b + 1)
    memo = {}

    def weigh(context, node):
        if (context, node) not in memo:
            own = kt(*counts[context, node]) if (context, node) in counts else 0.0
            rest = sum(weigh(c, node)[0] for c in children.get((context, node), ()))
            memo[context, node] = (own, 1.0) if len(context) == depth else (
                np.logaddexp(own, rest) - math.log(2), 1 / (1 + math.exp(min(700, max(-700, rest - own)))))
        return memo[context, node]

    out = []
    for text in low:
        total = 0.0
        for context, byte in steps(text):
            for j in range(8):
                node, bit, p = (1 << j) | byte >> (8 - j), byte >> (7 - j) & 1, 0.0
                for d in range(depth, -1, -1):
                    n = counts[context[:d], node] if (context[:d], node) in counts else [0, 0]
                    w = weigh(context[:d], node)[1]
                    p = w * (n[bit] + .5) / (sum(n) + 1) + (1 - w) * p
                total += math.log10(p)
        out.append(total)
    return out


def test_scores(docs_of, no_docs):
    rnd = random.Random(6)
    words = ["Alpha", "beta", "gamma", "déjà", "vu"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 25)))) for i in range(30)] + [
        (None, "alpha"), (40, None), (41, ""), (42, " \t\x00 unseen"), (42, "ALPHA beta"), (42, "ALPHA beta")]
    # One text longer than a block of 500 bytes.
    rows += [(None if i is None else 500 + i, t[:1500] if t else t) for i, t in ODD]
    docs = docs_of(rows)
    for block_bytes in (context_tree.BLOCK_BYTES, 500):
        got = context_tree.score(docs, block_bytes=block_bytes).collect()
        tokens = [(t or "").encode().translate(context_tree.ASCII_LOWER).split() + [None] for _, t in rows]
        for r in got:
            size = max(1, len((dict(rows[:30]).get(r.doc_id) or "").encode()))
            assert r.doc_id is None or r.doc_id >= 30 or r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / size)
        seen = Counter()
        for (i, _), own in zip(rows, tokens):
            if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
                seen.update(own)
        n, v = sum(seen.values()), len(seen)
        want = [(str(i), len(own), sum(seen[w] > 0 for w in own), n,
                 round(sum(math.log10((seen[w] + .5) / (n + .5 * (v + 1))) for w in own), 6), round(s, 3))
                for (i, _), own, s in zip(rows, tokens, plain_scores(rows))]
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3)) for r in got) == sorted(want)
    assert context_tree.score(no_docs).count() == 0
    # Nothing learned: eight bits a symbol.
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    alone = context_tree.score(docs_of([(one, "abc")])).first()
    assert alone.score == pytest.approx(-4 * 8 * math.log10(2), rel=1e-6) and alone.train_tokens == 0 and alone.n_known == 0


def test_pipeline_stages(spark, odd, no_docs, sf_small):
    import corpus_pipeline

    for docs in (odd, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_small)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() == docs.count()


def test_pipeline_runs(spark, sf_small, tmp_path):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, sf_small).collect()
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    firsts = {w[1] for w in plain_components(rows)}
    assert {r.doc_id for r in out} <= firsts
    # Of the stages' tables only the one that the result reads is left.
    left = {p.name.rsplit("-", 1)[0] for p in Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")).iterdir()}
    assert "benchmark_decontamination" in left and not left & {name for name, _ in corpus_pipeline.STAGES[:-2]}
    assert len(out) >= 0.9 * len(firsts)
