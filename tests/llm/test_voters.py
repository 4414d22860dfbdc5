"""Counting votes and choosing voters against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd

from foreledger.llm import toxicity


def plain_choice(found, fired, features):
    place = {t: i for i, t in enumerate(features)}
    sure = {r.term: r.a / (r.a + r.b) for r in found.itertuples()}
    held = {t: {k for k, f in enumerate(fired) if place[t] in f} for t in features}
    voters = list(toxicity.GIVEN)
    for term in found["term"]:
        if len(voters) >= toxicity.VOTERS or term in toxicity.GIVEN:
            continue
        rivals = [v for v in voters if sure.get(v, 0) >= sure[term]]
        if not any(2 * len(held[term] & held[v]) >= len(held[term]) for v in rivals):
            voters.append(term)
    return voters


def test_votes_and_voters(spark, monkeypatch):
    rnd = random.Random(5)
    new = [f"t{i}" for i in range(40)]
    features = [*toxicity.GIVEN, *new]
    fired = [sorted(rnd.sample(range(len(features)), rnd.randint(0, 9))) for _ in range(300)]
    for f in fired:  # pairs that go together
        f[:] = sorted({*f, *[x + 1 for x in f if x % 5 == 0 and x > 20 and x + 1 < len(features)]})
    rows = spark.createDataFrame([(f,) for f in fired], "fired array<int>")
    left, right = [3, 20, 41], list(range(len(features)))
    both, texts = toxicity.together(rows, left, right)
    want = [[sum(i in f and j in f for f in fired) for j in right] for i in left]
    assert texts == 300 and np.array_equal(both, want)
    assert toxicity.together(rows.limit(0), left, right)[1] == 0
    own = [sum(len(toxicity.GIVEN) + i in f for f in fired) for i in range(40)]
    found = pd.DataFrame({"term": new, "a": [(n + 1) // 2 for n in own], "b": [n // 2 for n in own]})
    for size in (7, 128):
        monkeypatch.setattr(toxicity, "ROUND", size)
        assert toxicity.choose_voters(found, features, rows) == plain_choice(found, fired, features)
    monkeypatch.setattr(toxicity, "VOTERS", 20)
    assert len(toxicity.choose_voters(found, features, rows)) == 20
