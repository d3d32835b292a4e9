"""Quality rules, BPE, decontamination, PII and toxicity."""

import collections
import hashlib
import math
import random
import zlib

import pytest

from waymark.llm import bpe, decontaminate, pii, quality, toxicity

SCHEMA = "doc_id long, text string, lang string, source string"


# Quality rules


def counts(text):
    text = text or ""
    ws = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = collections.Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    covered = set()
    for i in range(len(ws) - 7):
        if windows[tuple(ws[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    return len(ws), sum(len(w.decode()) for w in ws), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_odd_rows(spark):
    rng = random.Random(2)
    texts = [None, "", " \n ", "one", "a a a a a a a a a a a", "x y\nx y\n\n \nx y ", "é\u00a0ü | # <b> " * 30]
    texts += [" ".join(rng.choices("abcd", k=rng.randrange(1, 60))) for _ in range(20)] + ["word " * 3000]
    rows = [(k, t, ["en", None][k % 2], ["s", None, "t"][k % 3]) for k, t in enumerate(texts)]
    rows += [(None, "a null id", "en", "s"), rows[4], rows[4]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = quality.judge(df).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in names) == counts(r.text), r.doc_id
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def fences_of(rows):
    """Fences by hand, from sorted values: (lang, source) -> measure -> (lo, hi)."""
    values, wide = collections.defaultdict(list), collections.defaultdict(list)
    for _, text, lang, source in rows:
        n, chars, symbols, dups, _ = counts(text)
        lines = sum(1 for x in (text or "").split("\n") if x.encode().split())
        values[lang, source] += [(symbols / n, dups / lines, chars / n)] if n >= 20 else []
        wide[lang] += [(symbols / n, dups / lines, chars / n)] if n >= 20 else []
    out = {}
    for group, own in values.items():
        chosen = own if len(own) >= quality.LEAST else wide[group[0]]
        for k, m in enumerate(quality.TAIL):
            v = sorted(x[k] for x in chosen)
            if v:
                q1, q2, q3, q4, q5 = (v[max(1, math.ceil(round(p * len(v), 7))) - 1] for p in quality.QUANTILES)
                tail = quality.TAIL[m]
                out[group, m] = (q2 + 2 * (q2 - q3) + tail * (q1 - q2), q4 + 2 * (q4 - q3) + tail * (q5 - q4))
    return out


def varied(rng, n, symbols, repeated, width):
    """Texts of a source: its own symbols a word, repeated lines and word lengths, with some spread."""
    for _ in range(n):
        ws = ["".join(rng.choices("abcdefg", k=max(1, round(rng.gauss(width, 1))))) + "*" * (rng.random() < symbols) for _ in range(rng.randrange(60, 90))]
        lines = [" ".join(ws[k : k + 6]) for k in range(0, len(ws), 6)]
        yield "\n".join(x for k, x in enumerate(lines) for _ in range(1 + (rng.random() < repeated)))


def test_quality_fences_follow_the_group(spark):
    """Two sources that differ in a measure get different fences for it, and are judged by their own."""
    rng = random.Random(5)
    rows = []
    for source, *style in (("prose", 0.02, 0.02, 5), ("markup", 0.6, 0.02, 5), ("lyrics", 0.02, 0.12, 5), ("german", 0.02, 0.02, 9)):
        rows += [(len(rows) + k, t, "en", source) for k, t in enumerate(varied(rng, 150, *style))]
    rows += [(9000 + k, next(varied(rng, 1, 0.02, 0.02, 12)), "en", "small") for k in range(3)] + [(9100, "short", "xx", "none"), (9101, None, None, None)]
    odd = {source: next(varied(rng, 1, 0.6, 0.0, 5)) for source in ("prose", "markup")}
    rows += [(9200, odd["prose"], "en", "prose"), (9201, odd["markup"], "en", "markup")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.lang, r.source): r for r in quality.thresholds(quality.counted(df)).collect()}
    want = fences_of(rows)
    for (group, m), (lo, hi) in want.items():
        assert abs(got[group][f"{m}_hi"] - hi) < 1e-9, (group, m)
        assert m != "word_length" or abs(got[group].word_length_lo - lo) < 1e-9
    assert got["xx", "none"].symbols_hi is None and got[None, None].word_length_lo is None
    hi = lambda source, m: got["en", source][f"{m}_hi"]
    assert hi("markup", "symbols") > hi("prose", "symbols") + 0.2 and hi("lyrics", "dup_lines") > hi("prose", "dup_lines") and hi("german", "word_length") > hi("prose", "word_length") + 2
    kept = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    assert not kept[9200] and kept[9201] and sum(kept[k] for k in range(600)) >= 590 and not kept[9100]


def test_quality_plan_is_native_and_columns_pass(spark):
    rows = [(k, "some good words here " * 2 + " ".join(f"w{k}{j}" for j in range(30)), "en", "s", 7, 8, "x") for k in range(5)]
    df = spark.createDataFrame(rows, SCHEMA + ", n_words int, __mine int, __f_lang string")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == 5 and kept.first().n_words == 7
    judged = quality.judge(df)
    assert judged.first().n_words == 38 and judged.first()["__mine"] == 8 and judged.first()["__f_lang"] == "x" and judged.columns.count("n_words") == 1
    assert "text" not in quality.judge(df, keep_text=False).columns
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for part in (quality._repeats(quality._counts(docs, quality.F.col("text"))), quality.thresholds(quality.counted(docs)), quality.judge(docs)):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# BPE

tokenizers = pytest.importorskip("tokenizers")
ODD = [
    "", " ", "a" * 3000, "ab" * 900 + " x", "hi<|endoftext|>there <|endoftext|>", "\0<|endoftext|>", "日本語 テスト 123½ ²Ⅷ  \n\n x", "don't  \t  we'll x", "😀" * 300,
    " " * 50, "\x85a\x1cb\u2028c", "it's 'S 're'RE", "\ufeffx\u0301 e\u0301", "<|endoftext", "_-_ __ é_É", "12 345,6.7e8", "xyzzy" * 200 + "1" * 400,
]


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def test_bpe_equals_the_library(reference):
    with open(bpe.default_path(), encoding="utf-8") as f:
        codec = bpe.Codec(f.read())
    rng = random.Random(1)
    alphabet = "abcdeE  '\n\t.,12é日😀<|>s"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    for t in texts:
        want = reference.encode(t, add_special_tokens=False).ids
        assert codec.encode(t) == want
        assert codec.decode(want) == reference.decode(want, skip_special_tokens=False) == t


def test_bpe_query_rows(spark, reference):
    rows = [(k, t, None, None) for k, t in enumerate(ODD)] + [(None, "x", None, None), (1, None, None, None), (0, "", "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA + "").withColumnRenamed("lang", "ids")
    got = bpe.round_trip(df).collect()
    want = []
    for i, t, *_ in rows:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = bpe.decode(bpe.encode(df)).collect()
    assert sorted((r.doc_id, r.text) for r in back if r.doc_id is not None) == sorted((i, t or "") for i, t, *_ in rows if i is not None)
    assert bpe.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bpe_cache_may_overflow(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    monkeypatch.setattr(bpe, "CHUNK", 200)
    with open(bpe.default_path(), encoding="utf-8") as f:
        codec = bpe.Codec(f.read())
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdef", k=5)) for _ in range(30)) + "<|endoftext|>" for _ in range(60)]
    for t, (ids, _) in zip(texts, codec.texts(texts)):
        assert ids == ",".join(map(str, reference.encode(t, add_special_tokens=False).ids))


# Decontamination


def edit_distance(item, passage):
    before = [0] * (len(passage) + 1)
    for x in item:
        now = [before[0] + 1]
        for j, y in enumerate(passage):
            now.append(min(before[j] + (x != y), before[j + 1] + 1, now[-1] + 1))
        before = now
    return min(before)


def test_distance():
    rng = random.Random(1)
    for _ in range(500):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        b = [rng.randrange(4) for _ in range(rng.randrange(0, 20))]
        assert decontaminate.distance(a, b) == edit_distance(a, b)


def items(rng, n=40):
    return [(k, " ".join(f"i{k}x{rng.randrange(400)}" for _ in range(rng.randrange(3, 60)))) for k in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        kind, at = rng.random(), rng.randrange(len(words))
        if kind < 0.6:
            words[at] = f"zz{rng.randrange(999)}"
        elif kind < 0.8 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"zz{rng.randrange(999)}")
    return words


def test_contaminated_against_brute_force(spark):
    rng = random.Random(4)
    bench = items(rng) + [(90, None), (91, " .,! "), (92, "two words")]
    texts = []
    for k in range(200):
        i, t = rng.choice(bench[:40])
        ws = t.split()
        allowed = decontaminate.edits_allowed(len(ws))
        body = edited(rng, ws, rng.choice([0, allowed, allowed + 2, allowed * 3 + 3]))
        around = lambda: [f"f{rng.randrange(500)}" for _ in range(rng.randrange(25))]
        texts.append(" ".join([*around(), *body, *around()]))
    texts += [None, "", "...", "Two,   WORDS!", bench[5][1].upper().replace(" ", "; ")]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + [(None, bench[3][1], None, None), (0, texts[0], "en", "s")]
    found = decontaminate.contaminated(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(bench, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.edits for r in found}
    assert len(got) == len(found)
    clean = lambda t: "".join(c if c.isalnum() or not c.isascii() else " " for c in (t or "").lower()).split()
    want = {}
    for d, t, *_ in rows:
        for i, b in bench:
            if ws := clean(b):
                e = edit_distance(ws, clean(t))
                if e <= decontaminate.edits_allowed(len(ws)):
                    want[d, i] = e
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.98 * len(want) and {(d, i) for d, i in want if want[d, i] == 0} <= set(got)


def test_clean_documents_stay(spark):
    rng = random.Random(9)
    bench = items(rng, 5)
    rows = [(1, "x " + bench[2][1], "en", "s"), (2, "nothing here", "en", "s"), (3, None, None, None), (3, None, None, None)]
    b = spark.createDataFrame(bench, "item_id long, text string")
    kept = decontaminate.keep_clean(spark.createDataFrame(rows, SCHEMA), b)
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [2, 3, 3] and kept.columns == ["doc_id", "text", "lang", "source"]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(kept, none).count() == 0 and decontaminate.keep_clean(kept, none).count() == 3
    assert decontaminate.contaminated(spark.createDataFrame([], SCHEMA), b).count() == 0


# PII

TEXT = (
    'Mail Re.46@Mail8.Example.com or re.46@mail8.example.com, call +1 (499) 555-6503 / +14995556503, ip 10.0.0.1. card 4952935900253052 and 4952-9359-0025-3052 '
    'token = "1eb9c654e721b4f812088970e66a6345cee33dd6" Mrs. Anna Smith met Herr Karl Otto, господин Иванов; GB29NWBK60161331926819 123-45-6789'
)


def test_pii_formats_and_coreference():
    make = pii.Surrogates()
    found = [(k, TEXT[a:b], d) for a, b, k, d in pii.detect(TEXT)]
    assert [k for k, *_ in found] == ["email", "email", "phone", "phone", "ip", "card", "card", "secret", "name", "name", "name", "iban", "ssn"]
    new = [make.written(k, v, make.of(k, make.canonical(k, v), d)) for k, v, d in found]
    assert new[0].lower() == new[1] and new[0] != new[1]
    digits = lambda s: "".join(c for c in s if c.isdigit())
    assert digits(new[2]) == digits(new[3]) and new[2][0] == "+" and new[2][2:4] == " ("
    assert digits(new[5]) == digits(new[6]) and pii._luhn(new[5]) == 0
    assert set(new[7]) <= set("0123456789abcdef") and len(new[7]) == 40
    assert new[8].split()[0] in pii._GIVEN["latin", "f"] and new[9].split()[0] in pii._GIVEN["latin", "m"]
    assert all("а" <= c.lower() <= "я" for c in new[10]) and pii._mod97(new[11]) == 1
    for (k, v, _), n in zip(found, new):
        assert n != v
        if k not in ("name",):
            assert [c.isdigit() for c in n] == [c.isdigit() for c in v] or k in ("ip", "secret", "iban")


def test_pii_permutes_each_format():
    make = pii.Surrogates()
    for size in (1, 2, 7, 100, 1000):
        assert sorted(make._permute(x, size, "t") for x in range(size)) == list(range(size))
    assert len({make.of("ssn", f"{k:09d}") for k in range(2000)}) == 2000
    assert pii.Surrogates(b"other").of("ssn", "123456789") != make.of("ssn", "123456789")


def test_pii_rows_and_collisions(spark, monkeypatch):
    rows = [(1, TEXT, "en", "s"), (2, "clean text, nothing in it. version 1.2", "en", "s"), (3, None, None, None), (4, "", "en", "s"), (None, "ip 10.0.0.1", None, None), (1, TEXT, "en", "s")]
    df = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", n_entities int")
    got = pii.replace(df).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(by[1]) == 2 and by[1][0] == by[1][1] and by[1][0].n_entities == 13
    assert by[2][0].text == rows[1][1] and by[2][0].n_entities == 0 and by[3][0].text is None and by[4][0].text == ""
    assert by[None][0].text.removeprefix("ip ") in by[1][0].text
    for a, b, *_ in pii.detect(TEXT):
        assert TEXT[a:b] not in by[1][0].text
    assert pii.replace(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pii_resolve_makes_surrogates_distinct(spark):
    make = pii.Surrogates()
    values = [f"1.2.3.{k}" for k in range(6)]
    taken = make.of("ip", values[0])
    rows = [("ip", v, "", make.of("ip", values[0]) if k < 3 else make.of("ip", v)) for k, v in enumerate(values)] + [("ip", taken, "", make.of("ip", taken))]
    got = pii.resolve(spark.createDataFrame(rows, "kind string, value string, detail string, surrogate string")).collect()
    new = [r.surrogate for r in got]
    assert len(set(new)) == len(new) == 7 and not set(new) & {r.value for r in got}


# Toxicity


def toxic_corpus(seed=3, n=400):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ta", "re") for b in ("ne", "si", "do", "ru", "pa", "li")]
    bad = ["vilelex", "vilest", "vilemon", "grimword"]
    rows, labels = [], []
    for k in range(n):
        toxic = rng.random() < 0.25
        ws = rng.choices(plain, k=40) + (rng.choices(bad, k=3) if toxic else [])
        rng.shuffle(ws)
        rows.append((k, " ".join(ws), "en", "s"))
        if k % 5 != 4:
            labels.append((k, 1, int(toxic) if rng.random() > 0.03 else int(not toxic)))
    return rows, labels, bad


def test_toxicity(spark):
    rows, labels, bad = toxic_corpus()
    rows += [(1000, None, None, None), (1001, "", "en", "s"), (None, "vilest thing", "en", "s"), rows[0]]
    labels += [(None, 1, 1), (7, 0, None), (3, 0, 5), (5000, 1, 1)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA + ", score double")
    got = toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(any(b in (text[r.doc_id] or "") for b in bad)), (r, text[r.doc_id])


def test_toxicity_never_reads_held_out_labels(spark):
    rows, labels, _ = toxic_corpus(5, 200)
    docs = spark.createDataFrame(rows, SCHEMA)
    flipped = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in labels]
    run = lambda ls: sorted(map(tuple, toxicity.score(docs, spark.createDataFrame(ls, "doc_id long, quality int, toxic int")).collect()))
    assert run(labels) == run(flipped)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, none).first().score == 0.5
    assert toxicity.score(spark.createDataFrame([], SCHEMA), none).count() == 0
    one = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, one).first().predicted == 0
