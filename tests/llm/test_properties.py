"""Properties over generated inputs."""

import pytest
from hypothesis import given, settings, strategies as st

from waymark.llm import bpe, chat, decontaminate, html, pii, simhash, wordhash

tokenizers = pytest.importorskip("tokenizers")
TEXT = st.text(alphabet=st.sampled_from("ab cdé<|>\n\t.,'1 2s日😀"), max_size=80) | st.text(alphabet=st.characters(max_codepoint=0x2FFF, exclude_categories=("Cs", "Cn", "Mn", "Lo", "Lm", "No", "Nl")), max_size=40)


@pytest.fixture(scope="module")
def codecs():
    with open(bpe.default_path(), encoding="utf-8") as f:
        return bpe.Codec(f.read()), tokenizers.Tokenizer.from_file(bpe.default_path())


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_bpe(codecs, text):
    own, library = codecs
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids and own.decode(ids) == text


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab \n\té ", max_size=30), max_size=6))
def test_words(texts):
    import pyarrow as pa

    data, offsets = wordhash.buffers(pa.array(texts, pa.string()))
    starts, ends, bounds = wordhash.words(data, offsets)
    got = [[data[a:b].tobytes() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(bounds, bounds[1:])]
    assert got == [t.encode().split() for t in texts]
    h = wordhash.word_hashes(data, starts, ends)
    by = {}
    for w, x in zip([w for ws in got for w in ws], h.tolist()):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)


@settings(max_examples=200, deadline=None)
@given(page=st.text(alphabet=st.sampled_from("<>/pdivarticle =\"'&;!-x"), max_size=80))
def test_html_takes_anything(page):
    found, _, _ = html.lines(page)
    assert all(x and x == " ".join(x.split()) for x in found)


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("0123456789.-+()@abA_ =\"token"), max_size=80))
def test_pii_spans_and_formats(text):
    make, at = pii.Surrogates(), 0
    for a, b, kind, detail in pii.detect(text):
        assert at <= a < b <= len(text)
        at, value = b, text[a:b]
        written = make.written(kind, value, make.of(kind, make.canonical(kind, value), detail))
        assert kind == "ip" or len(written) == len(value)


@settings(max_examples=200, deadline=None)
@given(item=st.lists(st.integers(0, 3), min_size=1, max_size=8), passage=st.lists(st.integers(0, 3), max_size=12))
def test_distance_is_bounded(item, passage):
    d = decontaminate.distance(item, passage)
    assert 0 <= d <= len(item) and (d == 0) == any(passage[k : k + len(item)] == item for k in range(len(passage) + 1) if len(passage[k : k + len(item)]) == len(item))


@settings(max_examples=100, deadline=None)
@given(text=st.text(max_size=60), opening=st.booleans())
def test_observations_are_in_range(text, opening):
    seen, body = chat.observe(text, opening)
    assert all(0 <= x < n for x, n in zip(seen, chat.SHAPE)) and body == body.strip()


@settings(max_examples=100, deadline=None)
@given(text=st.text(max_size=60))
def test_fingerprint_ignores_spacing_and_ascii_case(text):
    spaced = "\n ".join(text.encode().decode().split(" "))
    upper = "".join(c.upper() if "a" <= c <= "z" else c for c in spaced)
    assert simhash.fingerprint(text) == simhash.fingerprint(upper) and 0 <= simhash.fingerprint(text) < 2**64
