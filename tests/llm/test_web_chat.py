"""HTML extraction, URL verdicts, chat roles, the pipeline."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from waymark.llm import chat, html, queries, urls

PAGES = "page_id long, url string, html string"


def body(*paragraphs, landmark=True):
    inner = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"<html><head><title>t</title><script>x('</p>')</script></head><body><nav><a>menu</a></nav>{'<article>' if landmark else ''}{inner}{'</article>' if landmark else ''}<footer>f</footer></body></html>"


def test_lines():
    page = (
        '<body><div class="cookie-notice">x</div><main><header><h1>T</h1></header><p class="ad">buy</p><p>a<b>b</b>c &amp; d&nbsp;e &#233;<ul><li>one<li>two</ul>'
        '<form>f</form><section id="comments"><p>c1</p></section><article class="comment">hi</article><div style="display: none">h</div></main><aside>z</aside><footer>f'
    )
    assert html.lines(page) == (["T", "abc & d e é", "one", "two"], [], True)
    assert html.lines('<p>a<p>b <script>if (a<b) x="</p>"</script> c<!-- d --> e < f <i') == (["a", "b c e < f"], [], False)
    assert html.lines("") == ([], [], False)
    page = '<body class="post"><div>top</div><div id="content"><div class="post-header"><h1>T</h1></div><div class="sidebar">s</div><p>x</p><div class="comment-content">c</div></div><div>end</div>'
    assert html.lines(page) == (["T", "x"], ["top", "end"], True)
    assert html.lines("<div class=content><p>menu here</p><article><p>a</p></article></div>") == (["a"], ["menu here"], True)


def lcs(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    return table


@pytest.mark.parametrize("whole", [html.WHOLE, 6])
def test_common_is_a_longest_subsequence(monkeypatch, whole):
    monkeypatch.setattr(html, "WHOLE", whole)
    rng = random.Random(1)
    for _ in range(300):
        a, b = rng.choices("abcd", k=rng.randrange(14)), rng.choices("abcd", k=rng.randrange(14))
        got = html.common(a, b)
        assert len(got) == lcs(a, b)[-1, -1] and got == sorted(set(got))
        rest = iter(b)
        assert all(a[i] in rest for i in got)


def test_thousands_of_equal_lines_cost_no_pairs():
    rng = random.Random(2)
    a, b = rng.choices("ab", k=6000), rng.choices("ab", k=6000)
    got = html.common(a, b)
    rest = iter(b)
    assert len(got) > 4000 and all(a[i] in rest for i in got)


def plain_extract(rows, order):
    """The query by brute force: every page against all pages of its host in the given order."""
    out = []
    pages = [(i, *plain_verdict(u)[:2], *html.lines(h or "")) for i, u, h in rows]
    unique = sorted(range(len(rows)), key=lambda k: order[k])
    unique = [k for n, k in enumerate(unique) if not n or order[unique[n - 1]] != order[k]]
    at = {order[k]: n for n, k in enumerate(unique)}
    for k, (i, host, path, own, rest, landmark) in enumerate(pages):
        n = at[order[k]]
        near = []
        for step in range(1, 1 + html.NEAR):
            for side, m in ((0, n - step), (1, n + step)):
                if 0 <= m < len(unique) and pages[unique[m]][1] == host:
                    q = pages[unique[m]]
                    same = next((x for x in range(min(len(path), len(q[2]))) if path[x] != q[2][x]), min(len(path), len(q[2])))
                    near.append((-same, step, side, q))
        shared, compared = [0] * len(own), 0
        for *_, q in sorted(near, key=lambda x: x[:3]):
            other = q[3] + q[4]
            table = lcs(own[::-1], other[::-1])
            x = y = 0
            places = []
            while x < len(own) and y < len(other):
                if own[x] == other[y]:
                    places.append(x)
                    x, y = x + 1, y + 1
                elif table[len(own) - x - 1, len(other) - y] >= table[len(own) - x, len(other) - y - 1]:
                    x += 1
                else:
                    y += 1
            held = sum(len(own[x]) for x in places)
            if places and held >= html.COPY * len("".join(own)) and held >= html.COPY * len("".join(q[3])):
                continue
            compared += 1
            for x in places:
                shared[x] += 1
            if compared == (html.ENOUGH_INSIDE if landmark else html.ENOUGH):
                break
        if landmark:
            gone = {x for x, c in enumerate(shared) if c == compared >= html.LEAST_INSIDE}
        else:
            gone = {x for x, c in enumerate(shared) if 2 * c > compared}
        out.append((i, " ".join(v for x, v in enumerate(own) if x not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 7, 90])
def test_extract_equals_brute_force(spark, parts):
    rng = random.Random(parts)
    rows = []
    for k in range(220):
        host = rng.choice(["a", "a", "a", "b", "c", "d.d"])
        # Each host's template has its own lines in a fixed order; articles share some lines, too.
        lines = [f"{host} line {n}" for n in range(4) if rng.random() < 0.8] + [f"story {k} {n}" for n in range(rng.randrange(4))]
        lines += [f"{host} end {n}" for n in range(2) if rng.random() < 0.9] + ["licence"] * (rng.random() < 0.3)
        rows.append((k, f"http://{host}.example/{rng.choice('xyz')}/{rng.randrange(60)}", body(*lines, landmark=rng.random() < 0.5)))
    rows += rows[5:9] + [(None, None, None), (None, None, body("q"))] + [(500 + k, "http://a.example/x/7", rows[3][2]) for k in range(20)]
    df = spark.createDataFrame(rows, PAGES)
    key = df.select(*(html.host_path(html.F.col("url"))), html.F.xxhash64("page_id", "url", "html"), html.F.xxhash64(html.F.lit("page"), "html", "url", "page_id"))
    order = [tuple(r) for r in key.collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = sorted(((r.page_id, r.text) for r in html.extract(df).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain_extract(rows, order)


def test_template_inside_a_landmark(spark):
    """A share bar in every article of a host goes; a licence that half of the articles have stays."""
    page = lambda k: body(f"story {k} is told here at length", "Share this story now", *["Licensed freely"] * (k % 2))
    rows = [(k, f"http://h.example.com/en/{k}", page(k)) for k in range(12)] + [(20 + k, f"http://small.example.com/en/{k}", page(k)) for k in range(3)]
    text = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(text[k] == f"story {k} is told here at length" + " Licensed freely" * (k % 2) for k in range(12))
    assert all("Share this story now" in text[20 + k] for k in range(3))  # too few pages to tell


def test_extract_by_differencing(spark):
    """Pages without a landmark lose the lines that they share with the nearest page of their host."""
    template = ["Welcome to our site", "All about us here"]
    rows = [(k, f"http://h.example.com/en/{k}", body(*template[:1], f"story {k} says something of its own", *template[1:], landmark=False)) for k in range(12)]
    rows += [(100, "http://copy.example.com/a/1", body("a whole page that was copied", landmark=False)), (101, "http://copy.example.com/a/2", body("a whole page that was copied", landmark=False))]
    rows += [(200, "http://alone.example.com/x", body("alone on its host", landmark=False)), (300, "http://h.example.com/en/5", body(*template, "kept whole")), (400, None, None), (401, None, ""), (402, "no scheme", body("p"))]
    rows += [rows[3], rows[3], (None, None, body("null id", landmark=False))]
    got = html.extract(spark.createDataFrame([(*r, 1) for r in rows], PAGES + ", text int")).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert all(text[k] == f"story {k} says something of its own" for k in range(12))
    assert text[100] == text[101] == "a whole page that was copied" and text[200] == "alone on its host"
    assert text[300] == "kept whole" and text[400] == text[401] == "" and text[402] == "p" and text[None] == "null id"
    assert all(r.n_chars == len(r.text) for r in got) and sum(r.page_id == 3 for r in got) == 3
    assert html.extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("parts", [1, 7, 120])
def test_ranges_lend_the_nearest_keys(spark, parts):
    rng = random.Random(2)
    keys = [(f"h{rng.randrange(3)}", f"/{rng.choice('aé')}/{rng.randrange(50)}", rng.randrange(9), k) for k in range(200)]
    cuts = html.ranges(spark.createDataFrame(keys, "host string, path string, k1 long, k2 long"), parts)
    order = sorted((h.encode(), p.encode(), a, b) for h, p, a, b in keys)
    own = [cuts.of(k)[0] for k in order]
    assert own == sorted(own) and len(set(own)) == len(cuts.bounds) <= parts
    for n, key in enumerate(order):
        want = {own[m] for m in range(max(0, n - html.NEAR), min(len(order), n + html.NEAR + 1))} - {own[n]}
        assert set(cuts.of(key)[1]) == want


def plain_verdict(url):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = max(((len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, None))
    return host, path, best[1], best[2]


def test_urls(spark):
    tests = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/7x?q#f", "http://example.com/en/8", "https://a.example.net/de/8", "https://example.net/de/9", "x://org/es/", "x://notorg/es/1",
        "http://É.org/es/a\nb?c", "http://casino-win.example.org/fr/1", "http://www.free-pills.example.com/de/4", "http://ththin.example.com/de/1", "a://b://c/d", "http://h?x=http://y/z", "http://" + "a" * 5000 + "/" + "b" * 5000,
    ]
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(tests)] + [(None, tests[4], "x"), (4, tests[4], "x")], "page_id long, url string, host string")
    out = urls.judge(df)
    got = out.collect()
    assert len(got) == len(tests) + 2
    for r in got:
        host, path, rule, verdict = plain_verdict(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    by = {r.page_id: r.verdict for r in got}
    assert by[13] == by[0] == by[2] == "allow"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def plain_score(url, weights, bias):
    """The model's score by hand: distinct hashed n-grams of host and path, each a vector of length one."""
    host, path = plain_verdict(url)[:2]
    z = bias
    for kind, text in (("h", f"^{host}$"), ("p", f"{path}$")):
        text = re.sub("[0-9]+", "0", text)
        seed = xxhash.xxh64_intdigest(kind.encode(), 42)
        grams = {xxhash.xxh64_intdigest(text[k : k + n].encode(), seed) % urls.BUCKETS for n in urls.SIZES for k in range(len(text) - n + 1)}
        z += sum(weights[g] for g in grams) / max(1, len(grams)) ** 0.5
    return 1 / (1 + np.exp(-z))


def test_url_scores_equal_brute_force(spark):
    rng = random.Random(5)
    tests = [u for u, _ in urls.labelled_urls()] + [None, "http://", "x://É.É/ß9?q", "http://h", "a://" + "b1" * 300 + "/" + "c" * 500]
    tests += [f"http://{''.join(rng.choices('abcdet.-19', k=rng.randrange(20)))}/{''.join(rng.choices('abc/17', k=rng.randrange(9)))}" for _ in range(100)]
    weights, bias = urls.fit(spark)
    got = urls.judge(spark.createDataFrame([(k, u) for k, u in enumerate(tests)], "page_id long, url string"), rules=()).collect()
    for r in got:
        assert abs(r.score - plain_score(r.url, weights, bias)) < 1e-9 and r.verdict == ("block" if r.score >= 0.5 else "allow")


def test_url_model_on_held_out_rows(spark):
    """Five folds of the labelled table; no host is in two rows."""
    table = urls.labelled_urls()
    hosts = [h for h in (plain_verdict(u)[0] for u, _ in table) if h and "wikipedia" not in h]
    assert len(set(hosts)) == len(hosts)
    random.Random(1).shuffle(table)
    right = 0
    for k in range(5):
        train = [r for n, r in enumerate(table) if n % 5 != k]
        got = urls.judge(spark.createDataFrame(table[k::5], "url string, label int"), rules=(), labelled=train).collect()
        right += sum((r.verdict == "block") == bool(r.label) for r in got)
    assert right >= 0.83 * len(table)


def turns_of(rng, conversations, marked=0.0):
    rows = []
    for c in range(conversations):
        roles = (["system"] if rng.random() < 0.3 else []) + ["user", "assistant"] * rng.randrange(1, 5)
        for t, role in enumerate(roles):
            size = {"system": 20, "user": 60, "assistant": 500}[role]
            text = "x" * rng.randrange(size // 2, size * 2) + ("?" if role == "user" and rng.random() < 0.7 else ".")
            name = {"system": "System", "user": "Human", "assistant": "AI"}[role]
            rows.append((c, t, role, f"{name}: {text}" if rng.random() < marked else text))
    return rows


CHAT = "conv_id long, turn long, role string, text string"


def test_chat_recovers_roles(spark):
    rng = random.Random(4)
    rows = turns_of(rng, 150)
    got = chat.recover(spark.createDataFrame(rows, CHAT)).collect()
    right = sum(r.given == r.role for r in got)
    assert len(got) == len(rows) and right >= 0.95 * len(rows)
    marked = turns_of(rng, 40, 1.0)
    blind = [(c, t, None, x) for c, t, _, x in marked]
    got = {(r.conv_id, r.turn): r for r in chat.recover(spark.createDataFrame(blind, CHAT)).collect()}
    assert all(got[c, t].role == role for c, t, role, _ in marked)
    r = got[0, 0]
    assert r.rendered.startswith(f"<|im_start|>{r.role}\n") and ": " not in r.rendered and r.rendered.endswith("<|im_end|>")


def test_chat_blocks_give_the_whole_path(spark, monkeypatch):
    rng = np.random.default_rng(1)
    steps, emit = np.log(rng.dirichlet(np.ones(4), 4)), rng.normal(size=(40, 4))
    whole = chat.viterbi(emit, steps)
    start = np.log(np.full(4, 0.25))
    first = emit.copy()
    first[0] += start
    assert chat.viterbi(first, steps) == whole
    ends = [whole[k * 8 + 7] for k in range(5)]
    path = chat.viterbi(first[:8], steps, ends[0])
    for k in range(1, 5):
        part = emit[8 * k : 8 * k + 8].copy()
        part[0] += steps[ends[k - 1]]
        path += chat.viterbi(part, steps, ends[k])
    assert path == whole
    rows = [(1, t, ["user", "assistant"][t % 2], "q?" if t % 2 == 0 else "y" * 400) for t in range(700)]
    df = spark.createDataFrame(rows + [(c + 10, *r) for c, *r in turns_of(random.Random(2), 20)], CHAT)
    got = {(r.conv_id, r.turn): (r.place, r.role) for r in chat.recover(df).collect()}
    assert len(got) == df.count() and [got[1, t][0] for t in range(700)] == list(range(700))
    monkeypatch.setattr(chat, "BLOCK", 10_000)
    assert {(r.conv_id, r.turn): (r.place, r.role) for r in chat.recover(df).collect()} == got


def test_chat_odd_rows(spark):
    rows = [(None, None, None, None), (1, None, "user", None), (1, 0, "nobody", ""), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, -5, "GPT", "### Human: x")]
    got = chat.recover(spark.createDataFrame([(*r, 1) for r in rows], CHAT + ", place int"))
    assert got.count() == len(rows)
    r = got.where("conv_id = 2").first()
    assert r.role == "user" and r.given == "assistant"
    assert chat.recover(spark.createDataFrame([], CHAT)).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no driver tables")
def test_pipeline_stages(spark):
    from waymark import tables as shared
    from waymark.llm import decontaminate, pii, quality, simhash

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "bpe"]
    good = shared.table(corpus_pipeline.good(spark, docs, sf), "t")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    one = shared.table(corpus_pipeline.distinct(spark, good, sf), "t")
    groups = simhash.near_duplicates(good).collect()
    assert {r.doc_id for r in one.collect()} == {r.component_id for r in groups}
    clean = shared.table(corpus_pipeline.clean(spark, one, sf), "t")
    bad = {r.doc_id for r in decontaminate.contaminated(one, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - bad
    private = shared.table(corpus_pipeline.private(spark, clean, sf), "t")
    assert private.columns == docs.columns
    text = {r.doc_id: r.text for r in clean.collect()}
    for r in private.collect():
        assert (r.text == text[r.doc_id]) == (not pii.detect(text[r.doc_id])) and r.n_chars == len(r.text)
    tokens = {tuple(r) for r in corpus_pipeline.tokens(spark, private, sf).collect()}
    assert {tuple(r) for r in corpus_pipeline.run(spark, sf).collect()} == tokens


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns through every stage."""
    prose = " ".join(f"word{k}" for k in range(40))
    other = " ".join(f"other{k}" for k in range(40))
    rows = [(1, prose, "en", "s", 1), (1, prose, "en", "s", 1), (2, prose + " tail", None, None, 2), (3, None, None, None, 3), (4, "", "en", "s", 4), (None, other, "en", "s", 5)]
    rows += [(5, other.replace("other", "third") + " 10.0.0.1", "en", "s", 6), (6, " ".join(f"long{k}" for k in range(60_000)), "en", "s", 7), (7, "item of the benchmark " + other.replace("other", "fourth"), "en", "s", 8)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    wide = spark.createDataFrame([(*r, "own", 9, True, "k") for r in rows], schema + ", kinds string, n_entities int, kept boolean, __row string")
    spark.createDataFrame([(1, "item of the benchmark"), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = wide
    left = {"quality": [1, 1, 2, 5, 6, 7, None], "near_duplicates": [1, 2, 5, 6, 7, None], "decontamination": [1, 2, 5, 6, None], "pii": [1, 2, 5, 6, None]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == wide.columns
        got = docs.collect()
        ids = sorted((r.doc_id for r in got), key=str)
        assert ids == sorted(left[name], key=str) or (name != "quality" and ids == sorted(set(left[name]) - {2}, key=str)), name
        assert all(r.kinds == "own" and r.n_entities == 9 and r["__row"] == "k" for r in got)
    five = next(r for r in got if r.doc_id == 5)
    assert "10.0.0.1" not in five.text and five.n_chars == len(five.text)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(got)
    docs = wide.where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_every_operator_has_a_query():
    names = queries.queries()
    assert {n.split("_")[0] for n in names} == {*(f"op{k}" for k in range(1, 11)), "pipeline"}
    assert set(queries.oracle_sql()) <= set(names)
