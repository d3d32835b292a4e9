"""The generative label model of the toxicity operator."""

import random

import numpy as np

from waymark.llm import toxicity

SCHEMA = "doc_id long, text string, lang string, source string"


def votes_of(rng, n, balance, rate1, rate0):
    y = rng.random(n) < balance
    fires = rng.random((n, len(rate1))) < np.where(y[:, None], rate1, rate0)
    return y, fires.astype(float)


def brute_posterior(fires, balance, rate1, rate0):
    """Row by row: joint probability of the votes cast under either class, abstentions left out."""
    out = []
    for row in fires:
        p1, p0 = balance, 1 - balance
        for v, a, b in zip(row, rate1, rate0):
            if v:
                p1, p0 = p1 * a, p0 * b
        out.append(p1 / (p1 + p0))
    return np.array(out)


def test_posterior_equals_bayes_by_hand():
    rng = np.random.default_rng(1)
    rate1, rate0, sign = np.array([0.5, 0.3, 0.1, 0.05]), np.array([0.02, 0.05, 0.4, 0.6]), np.array([1, 1, -1, -1])
    _, fires = votes_of(rng, 200, 0.3, rate1, rate0)
    model = toxicity.LabelModel(sign, rate1, rate0, 0.3)
    assert np.allclose(model.posterior(fires), brute_posterior(fires, 0.3, rate1, rate0))
    model.fit(fires, correlated=False)
    assert np.allclose(model.posterior(fires), brute_posterior(fires, model.balance, model.rate1, model.rate0))


def test_rates_come_from_the_votes():
    """Voters that start alike end apart where the other voters confirm or deny them."""
    rng = np.random.default_rng(2)
    rate1, rate0 = np.array([0.6, 0.6, 0.6, 0.3, 0.1, 0.1]), np.array([0.01, 0.01, 0.01, 0.3, 0.7, 0.7])
    sign = np.array([1, 1, 1, 1, -1, -1])
    y, fires = votes_of(rng, 4000, 0.3, rate1, rate0)
    start1, start0 = np.array([0.4] * 4 + [0.2] * 2), np.array([0.1] * 4 + [0.6] * 2)
    model = toxicity.LabelModel(sign, start1, start0, 0.3).fit(fires, correlated=False)
    ratio = model.rate1 / model.rate0
    assert ratio[3] < 0.5 * ratio[:3].min()
    assert ((model.posterior(fires) >= 0.5) == y).mean() > 0.93


def test_correlated_voters_share_one_vote():
    rng = np.random.default_rng(3)
    rate1, rate0, sign = np.array([0.3, 0.5]), np.array([0.1, 0.02]), np.array([1, 1])
    _, fires = votes_of(rng, 3000, 0.2, rate1, rate0)
    many = fires[:, [0, 0, 0, 0, 0, 1]]
    fit = lambda x, k: toxicity.LabelModel(sign[k], rate1[k], rate0[k], 0.2)
    one = fit(fires, [0, 1]).fit(fires).posterior(fires)
    copied = fit(many, [0, 0, 0, 0, 0, 1]).fit(many).posterior(many)
    naive = fit(many, [0, 0, 0, 0, 0, 1]).fit(many, correlated=False).posterior(many)
    lone = (fires[:, 0] == 1) & (fires[:, 1] == 0)
    assert np.abs(copied - one).max() < 0.05 and (naive - one)[lone].min() > 0.2


def test_the_posterior_is_not_the_label(spark):
    rng = random.Random(7)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ta", "re") for b in ("ne", "si", "do", "ru", "pa", "li")]
    bad = ["vilelex", "vilest", "vilemon", "grimword"]
    rows, labels = [], []
    for k in range(600):
        toxic = rng.random() < 0.3
        rows.append((k, " ".join(rng.choices(plain, k=40) + (rng.sample(bad, 3) if toxic else [])), "en", "s"))
        labels.append((k, int(toxic) if rng.random() > 0.08 else int(not toxic)))
    report = {}
    toxicity.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"), report=report)
    wrong = (report["posterior"] >= 0.5) != report["label"]
    assert 0.03 < wrong.mean() < 0.15  # the labels that were turned round
    assert {n[0] == "-" for n in report["names"]} == {True, False}


def test_long_and_repeated_texts(spark):
    voters = toxicity.Voters(["idiot", "abc*", "~shout", "-~polite", "-zz", "-:none"])
    text = "word " * 200_000 + "Idiot please!! abcd idiots zz"
    assert voters.votes(text) == [0, 1, 2, 3, 4] and voters.votes("nothing") == [5] and voters.votes(None) == voters.votes(" 1 ") == []
    docs = spark.createDataFrame([(1, "idiot", "en", "s")] * 3 + [(2, "fine words", "en", "s")], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs, labels).count() == 4
