"""Substring dedup and SimHash against brute force."""

import random

import numpy as np
import pytest
import xxhash

from waymark.llm import simhash, substring

SCHEMA = "doc_id long, text string, lang string, source string"


def corpus(seed=1, n=60):
    """Texts that share passages, exact and near copies, and odd ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = rng.choices(vocabulary, k=70)
    texts = []
    for k in range(n):
        ws = rng.choices(vocabulary, k=rng.randrange(0, 200))
        if k % 3 == 0:
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = passage[rng.randrange(10) : 70 - rng.randrange(10)]
        if k % 7 == 6:
            ws = texts[k - 3].split()
            if ws and k % 2:
                ws[rng.randrange(len(ws))] = "changed"
        texts.append(rng.choice([" ", "\n", "  ", "\t"]).join(ws))
    texts[5], texts[9], texts[11] = "", None, " \n\t "
    texts[13] = "é\u00a0ü " * 80  # not a space inside a word
    texts[14] = ("again and " * 80).strip()
    rows = [(100 - k if k % 2 else k, t, "en", "s") for k, t in enumerate(texts)]
    return rows + [(None, texts[0], None, None), (None, texts[3], "x", "y"), rows[3], rows[3]]


def removed(rows, window=50):
    first = {}
    words = [(t or "").encode().split() for _, t, *_ in rows]
    for (i, *_), ws in zip(rows, words):
        if i is not None:
            for p in range(len(ws) - window + 1):
                key = tuple(ws[p : p + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for (i, *_), ws in zip(rows, words):
        gone = [False] * len(ws)
        if i is not None:
            for p in range(len(ws) - window + 1):
                if first[tuple(ws[p : p + window])] < i:
                    gone[p : p + window] = [True] * window
        out.append((i, len(ws), sum(gone), substring.kept_of(ws, gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [None, 26, 16])
def test_substring_equals_brute_force(spark, bits):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = substring.kept_digest(substring.remove_repeats(docs, bits=bits)).collect()
    assert sorted(map(tuple, got), key=str) == removed(rows)


def test_substring_in_random_texts_of_few_words(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices("ab", weights=(9, 1), k=rng.randrange(40, 140))), "en", "s") for k in range(30)]
    got = substring.kept_digest(substring.remove_repeats(spark.createDataFrame(rows, SCHEMA))).collect()
    assert sorted(map(tuple, got), key=str) == removed(rows)


def test_sketch_follows_the_texts(spark):
    size = lambda n: substring.sketch_bits(spark.createDataFrame([(k, "x" * 10_000) for k in range(n)], "k int, text string"))
    assert size(1) == size(0) == 16 and size(400) == 19 and size(800) == 20
    assert substring.sketch_bits(spark.range(1).selectExpr("null as text")) == 16


def test_substring_very_long_texts(spark):
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(80)]
    long = [f"w{rng.randrange(10**6)}" for _ in range(120_000)]
    rows = [(1, " ".join([*long[:60_000], *passage, *long[60_000:]]), "en", "s"), (2, " ".join(["start", *passage, "end"]), "en", "s"), (3, " ".join(long[1000:1100]), "en", "s")]
    got = substring.kept_digest(substring.remove_repeats(spark.createDataFrame(rows, SCHEMA))).collect()
    assert sorted(map(tuple, got)) == removed(rows)


def test_substring_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring.remove_repeats(empty).count() == 0
    odd = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n_words int, row string")
    assert tuple(substring.remove_repeats(odd).first()) == (1, 2, 0, "a b")


def slow_fingerprint(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    shingles = [b" ".join(ws)] if len(ws) < 4 else [b" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint(spark):
    for _, text, *_ in corpus(2):
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    assert simhash.fingerprint("A É b") == simhash.fingerprint("a É b") != simhash.fingerprint("a é b")
    long = " ".join(f"x{k}" for k in range(3000))
    assert simhash.fingerprint(long) == slow_fingerprint(long)


def components(rows):
    fp = [(i, simhash.fingerprint(t)) for i, t, *_ in rows]
    nodes = {f for i, f in fp if i is not None}
    name = {f: min(i for i, g in fp if g == f and i is not None) for f in nodes}
    group = {f: {f} for f in nodes}
    for f in nodes:
        for g in nodes:
            if (f ^ g).bit_count() <= 4 and group[f] is not group[g]:
                group[f] |= group[g]
                for x in group[f]:
                    group[x] = group[f]
    return sorted(((i, f"{f:016x}", min(name[x] for x in group[f]) if f in group else None) for i, f in fp), key=str)


def test_simhash_equals_brute_force(spark):
    rows = corpus(4, 80)
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == components(rows)


def test_links_find_all_pairs_of_close_fingerprints(spark):
    """Chains, dense balls and lone fingerprints, straight into the link search."""
    rng = random.Random(6)
    fps = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.randrange(12)):
            for _ in range(rng.randrange(6)):
                base ^= 1 << rng.randrange(64)
            fps.add(base)
    ball = rng.getrandbits(64)
    fps |= {ball ^ (1 << k) for k in range(64)} | {ball ^ (3 << k) for k in range(63)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, node long")
    edges = simhash.links(nodes)
    pairs = edges.collect()
    assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in pairs)
    found = {r.node: r.component for r in simhash.components(edges).collect()}
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    assert all(found.get(k, k) == root(k) for k in range(len(fps)))


def test_a_long_run_gives_a_spanning_set():
    rng = np.random.default_rng(0)
    fp = np.array([0, *(1 << int(k) for k in rng.permutation(64)), 2**40 - 1], np.uint64)
    got = simhash._long_run(fp, np.arange(len(fp)), 0)
    assert len(got) <= len(fp) - 1 and all(int(fp[a] ^ fp[b]).bit_count() <= 4 for a, b in got)


def test_chain_longer_than_one_step(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(300, 301)], "a long, b long")
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    assert set(got.values()) == {0, 300} and len(got) == 203


def test_simhash_empty_and_keep_one(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    rows = [(3, "a b c d e f", "en", "s"), (2, "A b c d  e f", "en", "s"), (5, "quite other words are here today", "en", "s"), (None, "a b c d e f", None, None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 5]
    assert kept.columns == ["doc_id", "text", "lang", "source"]
    assert simhash.keep_one(empty).count() == 0


def test_keep_one_keeps_exactly_one_row_of_each_group(spark):
    """Repeated rows, one id on several texts, rows without an id, clashing columns."""
    a, b, c, d = ("a b c d e f g", "quite other words are here today", "something else again to be read", "no id has this text at all")
    rows = [(1, a), (1, b), (2, a), (2, a), (3, b), (3, b), (None, c), (None, c), (7, c), (None, d), (None, d), (9, None), (8, ""), (8, " ")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, fp int")
    kept = simhash.keep_one(df)
    assert kept.columns == ["doc_id", "text", "fp"]
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got in (sorted([(1, a), (1, b), (7, c), (None, d), (8, x)], key=str) for x in ("", " "))


def test_simhash_very_long_text(spark):
    text = " ".join(f"w{k % 977} x{k % 31}" for k in range(100_000))
    rows = [(1, text, "en", "s"), (2, text.upper(), "en", "s"), (3, "short", "en", "s")]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[2].component_id == 1 and got[1].fingerprint == f"{slow_fingerprint(text):016x}" and got[3].component_id == 3
