"""Roles against every possible path, and on conversations that no count has seen."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np

from waymark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_model(turns):
    """Log probabilities by hand, add-one smoothed: ``turns`` is {conversation: [(role, observations)]}."""
    k = len(chat.ROLES)
    start, steps = Counter(), Counter()
    features = [Counter() for _ in chat.SHAPE]
    size = Counter()
    for rows in turns.values():
        for n, (role, seen) in enumerate(rows):
            if role is None:
                continue
            size[role] += 1
            for f, v in enumerate(seen):
                features[f][role, v] += 1
            if n == 0:
                start[role] += 1
            elif rows[n - 1][0] is not None:
                steps[rows[n - 1][0], role] += 1
    log_start = [np.log((start[r] + 1) / (sum(start.values()) + k)) for r in range(k)]
    log_steps = [[np.log((steps[a, b] + 1) / (sum(steps[a, x] for x in range(k)) + k)) for b in range(k)] for a in range(k)]

    def emit(role, seen):
        total = 0.0
        for f, (n, v) in enumerate(zip(chat.SHAPE, seen)):
            count = [features[f][role, x] + 1 for x in range(n)]
            if f == 0:
                count[1 + role] += 1 + 0.5 * size[role]
            total += np.log(count[v] / sum(count))
        return total

    return log_start, log_steps, emit


def best_paths(rows, model):
    """Scores of all paths of one conversation, the best first."""
    log_start, log_steps, emit = model
    out = []
    for path in itertools.product(range(len(chat.ROLES)), repeat=len(rows)):
        score = log_start[path[0]] + sum(log_steps[a][b] for a, b in zip(path, path[1:])) + sum(emit(r, seen) for r, (_, seen) in zip(path, rows))
        out.append((score, path))
    return sorted(out, reverse=True)


def test_recover_equals_the_best_of_all_paths(spark):
    rng = random.Random(3)
    texts = ["Why?", "x" * 50, "y" * 400, "a\nb\nc", "User: hello", "### Assistant\nfine", "<|im_start|>system\nbe kind<|im_end|>", "", None, "z" * 900 + "?"]
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool", None, "nobody"]) if rng.random() < 0.3 else ["user", "assistant"][t % 2]
            rows.append((c, t, role, rng.choice(texts)))
    turns = defaultdict(list)
    for c, t, role, text in rows:
        known = chat.SPEAKERS.get((role or "").strip().lower())
        turns[c].append((chat.ROLES.index(known) if known else None, chat.observe(text, t == 0)[0]))
    model = plain_model(turns)
    got = defaultdict(dict)
    for r in chat.recover(spark.createDataFrame(rows, SCHEMA)).collect():
        got[r.conv_id][r.turn] = chat.ROLES.index(r.role)
    for c, seen in turns.items():
        ranked = best_paths(seen, model)
        found = tuple(got[c][t] for t in range(len(seen)))
        score = next(s for s, path in ranked if path == found)
        assert score > ranked[0][0] - 1e-9, (c, found, ranked[0])


def test_roles_of_conversations_never_counted(spark):
    """Half of the conversations lose their roles: their turns train nothing and are recovered all the same."""
    rng = random.Random(6)
    rows, truth = [], {}
    for c in range(200):
        roles = (["system"] if rng.random() < 0.3 else []) + ["user", "assistant"] * rng.randrange(1, 5)
        for t, role in enumerate(roles):
            size = {"system": 25, "user": 70, "assistant": 500}[role]
            text = "w" * rng.randrange(size // 2, size * 2) + ("?" if role == "user" and rng.random() < 0.7 else ".")
            truth[c, t] = role
            rows.append((c, t, role if c % 2 else None, text))
    got = chat.recover(spark.createDataFrame(rows, SCHEMA)).collect()
    held = [(r.role == truth[r.conv_id, r.turn]) for r in got if r.conv_id % 2 == 0]
    assert all(r.given is None for r in got if r.conv_id % 2 == 0) and sum(held) >= 0.93 * len(held)
