"""Benchmark passages of any length, with as many edits as are allowed."""

import random

import numpy as np
import pyarrow as pa
import pytest

from waymark.llm import decontaminate as D


def found(bench, texts):
    items = D.Items(list(range(len(bench))), [" ".join(b) for b in bench])
    return D.find(items, *D._normal(pa.array([" ".join(t) for t in texts], pa.string())))


def spread(rng, n, edits):
    """Places of edits, spread so that as many three-word runs as possible are hit, or anywhere."""
    return sorted(rng.sample(range(n), edits)) if rng.random() < 0.5 else [int(k) for k in np.linspace(1, n - 2, edits)]


@pytest.mark.parametrize("how", ["deleted", "replaced", "inserted", "mixed"])
@pytest.mark.parametrize("n", [6, 9, 14, 53, 100, 150, 200, 300])
def test_no_passage_is_lost(n, how):
    rng = random.Random(n)
    bench = [[f"i{k}x{rng.randrange(10_000)}" for _ in range(n)] for k in range(40)]
    texts = []
    for b in bench:
        body = list(b)
        for at in reversed(spread(rng, n, D.edits_allowed(n))):
            kind = rng.choice(["deleted", "replaced", "inserted"]) if how == "mixed" else how
            body[at : at + 1] = {"deleted": [], "replaced": ["zz"], "inserted": [body[at], "zz"]}[kind]
        texts.append([*(f"f{rng.randrange(500)}" for _ in range(rng.randrange(30))), *body, *(f"f{rng.randrange(500)}" for _ in range(rng.randrange(30)))])
    got = found(bench, texts)
    assert set(got) == {(k, k) for k in range(40)}
    assert all(got[k, k] == D.distance([hash(w) for w in bench[k]], [hash(w) for w in texts[k]]) for k in range(40))


def test_a_run_of_two_words_is_enough_for_five():
    bench = [list("abcde")]
    texts = [list("xabZdey"), list("xabdey"), list("abcQde"), list("aZcYe")]
    assert found(bench, texts) == {(0, 0): 1, (1, 0): 1, (2, 0): 1}


def test_small_items_against_brute_force():
    rng = random.Random(2)
    bench = [[rng.choice("abcdefgh") for _ in range(n)] for n in range(1, 16) for _ in range(4)]
    texts = [[rng.choice("abcdefgh") for _ in range(rng.randrange(30))] for _ in range(300)]
    want = {(t, i): e for t, x in enumerate(texts) for i, b in enumerate(bench) if (e := D.distance([ord(c) for c in b], [ord(c) for c in x])) <= D.edits_allowed(len(b))}
    assert found(bench, texts) == want


@pytest.mark.parametrize("how", ["deleted", "replaced", "inserted"])
def test_recall_at_every_length_with_edits_at_the_worst_places(how):
    """Edits that leave the shortest unbroken runs, and edits in the middle of every part."""
    rng = random.Random(11)
    bench, texts = [], []
    for n in range(1, 61):
        for _ in range(60):  # enough to tell 0.98 from 1
            b = [f"i{len(bench)}x{rng.randrange(10_000)}" for _ in range(n)]
            e, body = D.edits_allowed(n), list(b)
            worst = [int((k + 1) * (n + 1) / (e + 1)) - 1 for k in range(e)] if rng.random() < 0.7 else sorted(rng.sample(range(n), e))
            for at in reversed(worst):
                body[at : at + 1] = {"deleted": [], "replaced": ["zz"], "inserted": [body[at], "zz"]}[how]
            bench.append(b)
            texts.append([*(f"f{rng.randrange(500)}" for _ in range(rng.randrange(9))), *body, *(f"f{rng.randrange(500)}" for _ in range(rng.randrange(9)))])
    got = found(bench, texts)
    for n in range(1, 61):
        own = {(k, k) for k, b in enumerate(bench) if len(b) == n}
        assert len(own & set(got)) >= 0.98 * len(own), n
    assert len(got) >= 0.999 * len(bench)


def test_parts_hold_their_share_of_edits():
    for n in (1, 20, 21, 59, 300):
        items = D.Items([7], [" ".join(f"w{k}" for k in range(n))])
        assert items.part_size.sum() == n and items.part_size.max() <= D.PART
        assert items.part_edits.tolist() == [D.edits_allowed(n) // len(items.part_size)] * len(items.part_size)
        assert (items.walks > 0).all()


def test_walks_that_fall_short_give_way_to_verification(monkeypatch):
    monkeypatch.setattr(D, "MOST_WALKS", 1)
    D.walks_needed.cache_clear()
    try:
        test_no_passage_is_lost(53, "mixed")
    finally:
        D.walks_needed.cache_clear()


def test_long_texts_and_ties():
    bench = ["one two three four five six seven eight nine ten", ""]
    text = "x " * 100_000 + "one two three four five six seven EIGHT, nine! ten " * 3 + "y " * 100_000 + "one two three four five six zz eight nine ten"
    items = D.Items([0, 1], bench)
    assert D.find(items, *D._normal(pa.array([text, None, "", text], pa.string()))) == {(0, 0): 0, (3, 0): 0}
