"""Toxicity scores by weak supervision.

Voters of several kinds vote on a text. For label 1: words of a small general
lexicon (``LEXICON``), words and word beginnings (``ab*``) mined from a bounded
labelled sample, and patterns. For label 0: patterns of polite, quoted or tabular
matter, mined words, and the lack of any vote for label 1. Labels choose and
orient voters, which is where their rates start from; they cast no vote.

A generative model with a latent class then estimates by expectation
maximization, from the votes alone, the class balance, how often each voter
votes in either class (its accuracy), and the voters' correlations within a
class: correlated voters share one vote's weight. A voter that does not vote
abstains. A logistic regression is trained on the posterior labels; its scores
are calibrated (slope and bias) on the sample's labels and score every text.

Only rows of the training folds are ever read from the labels; label, language,
source and id are not inputs of a score. ``SAMPLE`` bounds the sample for each
label, ``VOTERS`` the model, so the fit costs the same at every corpus size;
scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .. import tables as shared

FOLDS, SAMPLE, VOTERS, CLEAN, LEAST, LIFT = 5, (4000, 2000), 300, 40, 4, 2.0
#: Mined voters must be this unlikely (as a negative logarithm) to be so uneven by chance; some 100,000 words and beginnings are tried.
EVIDENCE = 12.0
ROUNDS, STEPS, RIDGE = 50, 25, 0.3
#: Pseudo-rows, for each row of the sample, behind the rates that a voter starts from; votes that no other voter confirms or denies say nothing of them.
PRIOR = 2
BEGINNINGS = (3, 4, 5, 6, 7)
_WORD = re.compile(r"[^\W\d_]+")
#: Words of abuse in four languages, general knowledge and no list of the tables'.
LEXICON = frozenset(
    "arse arsehole ass asshole bastard bitch bollocks bullshit clown coward creep cretin crap damn degenerate dickhead disgrace disgusting douche dumb dumbass "
    "failure filth filthy fool freak fuck fucking garbage hate hateful horrible idiot idiotic idiots imbecile jerk liar loser losers lunatic maggot moron moronic "
    "morons nasty parasite pathetic pig pigs prick psycho retard rubbish scum shit shitty sick slut stupid stupidity subhuman suck sucks trash twat ugly useless "
    "vermin vile whore worthless wretch "
    "abschaum arsch arschloch bloed blöd blöde depp dreck dumm dumme dummkopf drecksau hure idioten miststück missgeburt schlampe schwachkopf schwein scheisse scheiße "
    "trottel versager widerlich wertlos "
    "abruti batard bâtard bouffon connard connasse cretin crétin débile degueulasse dégueulasse imbécile merde minable nul ordure pourri pute salaud salope stupide "
    "basura cabron cabrón cerdo escoria estupido estúpida estúpido gilipollas idiota imbecil imbécil inutil inútil mierda pendejo puta puto tonto".split()
)
_PATTERNS = {
    "~shout": re.compile(r"!{2,}"),
    "~capitals": re.compile(r"[A-Z]{4}(?:\W+[A-Z]{3,}){2,}"),
    "~you": re.compile(r"\b[Yy]ou(?:'re| are| all)\b"),
    "~masked": re.compile(r"\w[*@#]{2,}\w"),
    "~away": re.compile(r"\b(?:shut up|go to hell|get lost|drop dead|halt die|va te|ta gueule|vete a)\b", re.I),
    "-~polite": re.compile(r"\b(?:please|thank you|thanks|kindly|sincerely|bitte|danke|merci|cordialement|gracias|por favor)\b", re.I),
    "-~quoted": re.compile(r"(?:https?://|\bdoi:|\bISBN\b|\bet al\b|\blicen[cs]ed?\b|©|\bcopyright\b)", re.I),
    "-~table": re.compile(r"[|;\t][^|;\t\n]{1,40}[|;\t][^|;\t\n]{1,40}[|;\t]"),
}
#: What a text must hold (one of these words, or of these characters) for a pattern to be tried.
_GUARDS = {
    "~shout": ("!!",),
    "~you": frozenset(("you",)),
    "~masked": ("**", "@@", "##", "*@", "*#", "@*", "@#", "#*", "#@"),
    "~away": frozenset(("shut", "go", "get", "drop", "halt", "va", "ta", "vete")),
    "-~polite": frozenset(("please", "thank", "thanks", "kindly", "sincerely", "bitte", "danke", "merci", "cordialement", "gracias", "por")),
    "-~quoted": ("://", "doi", "DOI", "Doi", "ISBN", "isbn", "et al", "ET AL", "Et al", "icen", "ICEN", "©", "opyright", "OPYRIGHT"),
    "-~table": ("|", ";", "\t"),
}
#: The voter for label 0 of texts with words, but without any vote for label 1.
_NONE = "-:none"


def features(text: str | None) -> set[str]:
    """All words and word beginnings of a text outside the lexicon: what may be mined."""
    words = set(_WORD.findall((text or "").lower())) - LEXICON
    out = set(words)
    for k in BEGINNINGS:
        out |= {w[:k] + "*" for w in words if len(w) > k}
    return out


class Voters:
    """A fixed list of voters; the names of those that vote for label 0 begin with ``-``."""

    def __init__(self, names: list[str]):
        self.names = names
        self.sign = np.array([-1 if v[0] == "-" else 1 for v in names], int)
        place = {v: k for k, v in enumerate(names)}
        self.none = place.get(_NONE)
        self.patterns = [(k, _PATTERNS[v]) for v, k in place.items() if v in _PATTERNS]
        self.starts = {n: {v[:-1]: k for v, k in place.items() if v[-1] == "*" and len(v) == n + 1} for n in BEGINNINGS}
        self.words = {v.lstrip("-"): k for v, k in place.items() if v not in _PATTERNS and v != _NONE and v[-1] != "*"}
        self.keys = frozenset(self.words)
        self.first = frozenset(v[: BEGINNINGS[0]] for starts in self.starts.values() for v in starts)

    def votes(self, text: str | None) -> list[int]:
        """The places of all voters that vote on a text; a text without words has no votes but of patterns."""
        text = text or ""
        words = set(_WORD.findall(text.lower()))
        out = [self.words[w] for w in words & self.keys]
        some_start = [w for w in words if w[: BEGINNINGS[0]] in self.first and w not in LEXICON] if self.first else ()
        for n, starts in self.starts.items():
            if some_start and starts:
                out += [starts[w] for w in {w[:n] for w in some_start if len(w) > n} & starts.keys()]
        for k, pattern in self.patterns:
            guard = _GUARDS.get(self.names[k])
            if guard is None or (not words.isdisjoint(guard) if isinstance(guard, frozenset) else any(x in text for x in guard)):
                if pattern.search(text):
                    out.append(k)
        if words and self.none is not None and not any(self.sign[k] > 0 for k in out):
            out.append(self.none)
        return sorted(out)


def held_out(id_col: Column) -> Column:
    """Whether a row is in the fold that is never learned from; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == 0, F.lit(False))


class LabelModel:
    """Class balance, rates of each voter in both classes, and the voters' correlations within a class.

    ``posterior`` is the probability of class 1 given votes (rows x voters): prior
    odds times the ratio of rates of every voter that votes, each to the power of
    one over the sum of its correlations with the voters of that row.
    """

    def __init__(self, sign: np.ndarray, rate1: np.ndarray, rate0: np.ndarray, balance: float):
        """Starts from the given rates, which say no more than how a voter is oriented and how firmly."""
        self.sign, self.balance = sign, balance
        self.rate1, self.rate0 = (np.clip(r, 1e-6, 1 - 1e-6) for r in (rate1, rate0))
        self.together = np.eye(len(sign))

    def odds(self, fires: np.ndarray) -> np.ndarray:
        each = fires / np.maximum(fires @ self.together, 1)
        return each @ (np.log(self.rate1) - np.log(self.rate0)) + np.log(self.balance / (1 - self.balance))

    def posterior(self, fires: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(fires), -30, 30)))

    def fit(self, fires: np.ndarray, rounds: int = ROUNDS, correlated: bool = True) -> LabelModel:
        """Expectation maximization over the votes."""
        fires, n = fires.astype(float), len(fires)
        start1, start0, balance, prior = self.rate1, self.rate0, self.balance, PRIOR * len(fires)
        q = self.posterior(fires)
        for _ in range(rounds):
            one, zero = q.sum(), (1 - q).sum()
            self.balance = float((one + prior * balance) / (n + prior))
            self.rate1 = np.clip((fires.T @ q + prior * balance * start1) / (one + prior * balance), 1e-6, 1 - 1e-6)
            self.rate0 = np.clip((fires.T @ (1 - q) + prior * (1 - balance) * start0) / (zero + prior * (1 - balance)), 1e-6, 1 - 1e-6)
            if correlated:
                # What the class leaves unexplained of each pair of voters of one orientation.
                rest = fires - np.outer(q, self.rate1) - np.outer(1 - q, self.rate0)
                spread = np.sqrt((rest**2).sum(axis=0)) + 1e-9
                together = np.clip((rest.T @ rest) / np.outer(spread, spread), 0, 1)
                together *= np.outer(self.sign, self.sign) > 0
                self.together = together * (together > 0.1)
                np.fill_diagonal(self.together, 1)
            new = self.posterior(fires)
            if np.abs(new - q).max() < 1e-6:
                break
            q = new
        return self


def classifier(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton steps with a ridge."""
    x1 = np.c_[x, np.ones(len(x))]
    w = np.zeros(x1.shape[1])
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-6
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (p - q) + ridge * w
        hess = (x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fixed = Voters([*sorted(LEXICON), *_PATTERNS])
    for b in batches:
        found = [sorted(features(x.as_py())) for x in b.column("text")]
        votes = [[fixed.names[k] for k in fixed.votes(x.as_py())] for x in b.column("text")]
        some = [bool(_WORD.search(x.as_py() or "")) for x in b.column("text")]
        strings = pa.list_(pa.string())
        yield pa.record_batch([b.column("toxic"), pa.array(found, strings), pa.array(votes, strings), pa.array(some)], names=["toxic", "found", "votes", "some"])


def _inputs(votes: list[int], sign: np.ndarray) -> np.ndarray:
    """A row of the classifier: the votes, whether any is for label 1, and how many."""
    row = np.zeros(len(sign) + 2)
    row[votes] = 1
    n = sum(1 for k in votes if sign[k] > 0)
    row[-2], row[-1] = min(n, 1), np.log1p(n)
    return row


def _apart(names: list[str], rows: list[set[str]]) -> list[str]:
    """``names``, best first, without beginnings that vote on about the texts of an earlier voter nested with them."""
    of = {v: frozenset(k for k, r in enumerate(rows) if v in r) for v in names}
    out: list[str] = []
    for v in names:
        stem = v.rstrip("*")
        near = (u for u in out if u.rstrip("*").startswith(stem) or stem.startswith(u.rstrip("*")))
        if all(len(of[v] & of[u]) < 0.7 * len(of[v] | of[u]) for u in near):
            out.append(v)
    return out


class Fitted:
    """Voters, label model, and the classifier's weights and bias."""

    def __init__(self, voters: Voters, weights: np.ndarray, bias: float):
        self.voters, self.weights, self.bias = voters, weights, bias

    def odds(self, text: str | None) -> float:
        votes = self.voters.votes(text)
        if not votes:
            return self.bias
        n = sum(1 for k in votes if self.voters.sign[k] > 0)
        return self.bias + self.weights[votes].sum() + self.weights[-2] * min(n, 1) + self.weights[-1] * np.log1p(n)


def sampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[int, int], DataFrame | None]:
    """How many usable rows have either label, and what the sampled texts hold (toxic, found, votes, some)."""
    named = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
    usable = named.where(F.col("__id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("__id"))).groupBy("__id").agg(F.max("toxic").alias("toxic"))
    usable = shared.table(usable, "labels")
    total = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return total, None
    chosen = [usable.where(F.col("toxic") == k).orderBy(F.xxhash64("__id"), "__id").limit(n) for k, n in enumerate(SAMPLE)]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # at most sum(SAMPLE) rows of two numbers
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text")).join(sample, "__id")
    texts = texts.select("toxic", "text").dropDuplicates()  # copies would count as evidence of their own
    return total, shared.table(texts.mapInArrow(_mined, "toxic int, found array<string>, votes array<string>, some boolean"), "mined")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", report: dict | None = None) -> Fitted:
    """The scorer, from at most ``SAMPLE`` labelled texts of either label.

    Rows of ``labels`` with a null id or a label other than 0 and 1 are left
    out; of several labels for one id the largest counts. The sample is the
    rows with the smallest hash of the id. With one label only, or none, the
    score is constant: 0.5, 0 or 1. ``report``, if given, gets the sample's
    votes, labels and posteriors.
    """
    total, found = sampled(docs, labels, id_col, text_col)
    if found is None:
        return Fitted(Voters([]), np.zeros(2), {0: -30.0, 1: 30.0}.get(next(iter(total), -1), 0.0))
    size = found.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not size[0] or not size[1]:
        return Fitted(Voters([]), np.zeros(2), 0.0)
    counts = found.select("toxic", F.explode("found").alias("voter")).groupBy("voter").agg(F.sum("toxic").alias("p"), F.count("*").alias("n"))
    lift = F.log((F.col("p") + 0.5) / (size[0] + 1)) - F.log((F.col("n") - F.col("p") + 0.5) / (size[1] + 1))
    rate, p, rest = size[1] / (size[0] + size[1]), F.col("p"), F.col("n") - F.col("p")
    # Chernoff's bound on a share of label 1 as far from the sample's as this one.
    odd = p * F.log(F.greatest(p, F.lit(1)) / (F.col("n") * (1 - rate))) + rest * F.log(F.greatest(rest, F.lit(1)) / (F.col("n") * rate))
    counts = shared.table(counts.where(F.col("n") >= LEAST).withColumns({"lift": lift, "odd": odd}).where(F.col("odd") >= EVIDENCE), "counts")
    toxic = counts.where(F.col("lift") >= LIFT).orderBy((p * F.col("lift")).desc(), "voter").limit(2 * VOTERS)
    toxic = [r.voter for r in toxic.collect()]
    clean = counts.where((F.col("lift") <= -LIFT) & ~F.col("voter").endswith("*"))
    clean = [r.voter for r in clean.orderBy(F.col("n") * F.col("lift"), "voter").limit(CLEAN).collect()]
    kept = F.array_intersect("found", F.lit([*toxic, *clean]) if toxic or clean else F.array().cast("array<string>"))
    rows = found.select("toxic", kept.alias("found"), "votes", "some").collect()  # at most sum(SAMPLE) short rows
    rows.sort()  # sums in one order, whatever the partitions
    label = np.array([r.toxic for r in rows])
    sets = [set(r.found) for r in rows]
    mined = _apart(toxic, sets)[:VOTERS]
    names = [*sorted(LEXICON), *_PATTERNS, *mined, *(f"-{v}" for v in clean)]
    sets = [s & set(mined) | {f"-{v}" for v in s & set(clean)} | set(r.votes) for s, r in zip(sets, rows)]
    # Voters of the fixed kinds that the labels contradict, or that are never heard, are left out.
    share = label.mean()
    heard = {v: label[[k for k, s in enumerate(sets) if v in s]] for v in names}
    names = [v for v in names if len(y := heard[v]) and not (len(y) >= LEAST and (y.mean() < share) == (v[0] != "-"))]
    voters = Voters([*names, _NONE])
    place = {v: k for k, v in enumerate(voters.names)}
    votes = [sorted(place[v] for v in s if v in place) for s in sets]
    for k, v in enumerate(votes):
        if rows[k].some and not any(voters.sign[j] > 0 for j in v):
            v.append(voters.none)
    x = np.array([_inputs(v, voters.sign) for v in votes])
    fires = x[:, : len(voters.names)]
    start = [(fires[label == k].sum(axis=0) + 0.5) / (size[1 - k] + 1) for k in (1, 0)]
    model = LabelModel(voters.sign, *start, float(share)).fit(fires)
    posterior = model.posterior(fires)
    w, bias = classifier(x, posterior)
    # Calibrated on the labels: one slope and one bias, then moved from the sample's share of label 1 to that of all labels.
    slope, offset = classifier((x @ w + bias)[:, None], label.astype(float))
    slope = max(float(slope[0]), 0.05)
    offset += np.log(total[1] / total[0]) - np.log(size[0] / size[1])
    if report is not None:
        report |= {"x": x, "label": label, "posterior": posterior, "model": model, "names": voters.names}
    return Fitted(voters, w * slope, float(bias * slope + offset))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row of ``docs``.

    Null text counts as empty and gets the score of a text without votes; whole
    texts vote, however long. Equal texts, and so repeated rows, score alike
    whatever their other columns, and come out as often as they went in. Copies
    of a labelled text with one label count once in the sample; ties in the
    choice of voters go by name. An empty table gives no rows; other columns are
    unused.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for b in batches:
            z = np.array([fitted.odds(x.as_py()) for x in b.column("text")], float)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return source.mapInArrow(of, "doc_id long, held_out boolean, score double, predicted int")
