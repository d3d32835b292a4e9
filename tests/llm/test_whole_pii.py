"""Personal data in any script, and formats whose values are used up."""

import re

import pytest

from waymark.llm import pii

TEXTS = [
    'password = "********"',
    "mail 用户@例子.中国 now",
    "mail דני@דואר.קום now",
    "mail علي@بريد.شبكة now",
    "call +٤٩ ٣٠ ١٢٣٤٥٦٧ today",
    "call +९१ ९८७६५ ४३२१० today",
    "card ٤١١١١١١١١١١١١١١١ used",
    'secret: "!!!!!!😀"',
]


@pytest.mark.parametrize("text", TEXTS)
def test_any_script_is_replaced(text):
    make = pii.Surrogates()
    found = pii.detect(text)
    assert found
    for a, b, kind, detail in found:
        value = text[a:b]
        new = make.written(kind, value, make.of(kind, make.canonical(kind, value), detail))
        assert new != value and len(new) == len(value)
        kept = [(x, y) for x, y in zip(value, new) if x.isalnum() and x == y]
        assert len(kept) <= len(value) // 2
        assert [len(x) for x in re.findall(r"\d+|\s", new)] == [len(x) for x in re.findall(r"\d+|\s", value)] or kind == "secret"


def test_such_rows_do_not_stop_the_query(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert all(got[k].text != t and got[k].n_entities == 1 for k, t in rows)


def test_full_formats_get_wider(spark):
    make, letters = pii.Surrogates(), "abcdefghijklmnopqrstuvwxyz"
    values = [f"{a}@{b}.co" for a in letters for b in letters]
    rows = [("email", v, "", make.of("email", v)) for v in values]
    got = pii.resolve(spark.createDataFrame(rows, "kind string, value string, detail string, surrogate string")).collect()
    assert len(got) == len(values) == len({r.surrogate for r in got})
    assert not {r.surrogate for r in got} & set(values)
    assert all(r.surrogate.endswith(".co") and len(r.surrogate) > len(r.value) for r in got)


@pytest.mark.parametrize("kind, value", [("ip", "10.2.3.4"), ("email", "a@b.co"), ("card", "4111111111111111"), ("iban", "DE89370400440532013000"), ("phone", "12345"), ("ssn", "123456789"), ("secret", "******"), ("name", "anna")])
def test_wider_surrogates_are_written_whole(kind, value):
    make = pii.Surrogates()
    detail = "f" if kind == "name" else ""
    several = {make.of(kind, value, detail, pii.NARROW + k) for k in range(30)}
    assert len(several) == 30 and value not in several
    for s in several:
        assert make.written(kind, value, s).lower() == s.lower()
        assert kind != "card" or pii._luhn(s) == 0
        assert kind != "iban" or pii._mod97(s) == 1
