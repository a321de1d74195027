"""The model of random strings against identifiers: held-out strings of both kinds, and its counts."""

import base64
import math
import random
from collections import Counter

import numpy as np
import pytest

from tripweave.llm import secrets

SF_DIR = "/root/testdata/sf0.01"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

# None of these words is among those that the model knows.
HELD_OUT = (
    "ledger invoice customer shipping warehouse payment calendar weather station bicycle journey profile "
    "quantum morning bridge garden purple dragon silver mountain river forest compile linker pointer widget "
    "renderer scanner lexer grammar optimizer planner executor shuffle partition broadcast snapshot replica "
    "quorum election heartbeat balance throttle retry backoff circuit breaker metric histogram gauge"
).split()


@pytest.fixture(scope="module")
def model(spark):
    return secrets.train(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def random_string(rng):
    n = rng.randrange(20, 65)
    return rng.choice([
        lambda: "".join(rng.choice(LETTERS) for _ in range(n)),
        lambda: "".join(rng.choice(LETTERS[:26] + LETTERS[52:]) for _ in range(n)),
        lambda: base64.b64encode(rng.randbytes(n * 3 // 4)).decode(),
        lambda: base64.urlsafe_b64encode(rng.randbytes(n * 3 // 4)).decode().rstrip("="),
    ])()


def identifier(rng):
    while True:
        words = [rng.choice(HELD_OUT) for _ in range(rng.randrange(2, 6))]
        titles = [w.title() for w in words]
        out = rng.choice([
            "_".join(words), "_".join(words).upper(), "".join(titles), "/".join(words), "-".join(words),
            words[0] + "".join(titles[1:]),
        ]) + (str(rng.randrange(1, 2030)) if rng.random() < 0.15 else "")
        if len(out) >= secrets.LEAST_RANDOM:
            return out


def test_held_out_strings(model):
    assert not set(HELD_OUT) & set(secrets.IDENTIFIER_WORDS)
    rng = random.Random(12)
    found = [model.of(random_string(rng).encode()) >= secrets.LEAST_RATIO for _ in range(2000)]
    wrong = [model.of(identifier(rng).encode()) >= secrets.LEAST_RATIO for _ in range(2000)]
    assert sum(found) / 2000 >= 0.95
    assert sum(found) / (sum(found) + sum(wrong)) >= 0.95


@pytest.mark.parametrize("text", [
    "com/example/project/internal/service/impl", "AbstractSingletonProxyFactoryBean",
    "MAXIMUM_CONNECTION_TIMEOUT_SECONDS", "NotImplementedErrorException", "1234567890123456789", "=" * 24,
    "-" * 80, "2024-01-31/2024-02-28", "aaaaaaaaaaaaaaaaaaaaaaaa",
])
def test_ordinary_strings(model, text):
    assert model.of(text.encode()) < 0


def test_the_model_counts_all_texts(spark):
    """The chains from counts by plain loops, and the ratio of a string from the chains."""
    texts = ["The quick-brown fox/es", "password=Zq81xKfW02mQpL77 and more", None, "été X9", ""] * 3
    model = secrets.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    place = {c: i for i, c in enumerate(secrets._TOKEN)}
    n, other = len(place), len(place)
    counts = {"plain": Counter(), "secret": Counter()}
    for t in texts:
        states = [place.get(chr(b), other) for b in (t or "").encode()]
        value = [place[c] for c in "Zq81xKfW02mQpL77"] if t and "password" in t else []
        counts["secret"].update(zip(value[:-1], value[1:], strict=True))
        counts["plain"].update(zip(states[:-1], states[1:], strict=True))
    counts["plain"] -= counts["secret"]
    total = sum(counts["secret"].values())
    columns = Counter()
    for (_, b), k in counts["secret"].items():
        columns[b] += k
    chance = [((columns[b] + 100) / (total + 100 * n) + 1 / n) / 2 for b in range(n)]
    table = np.zeros((n + 1, n + 1))
    for (a, b), k in counts["plain"].items():
        table[a, b] = k
    for c in place.values():  # first and last characters of texts stand beside line ends
        assert np.isfinite(model.ratio[c]).all()
    ordinary = 0.97 * secrets._ordinary(table) + 0.03 / n
    ordinary /= ordinary.sum(axis=1, keepdims=True)
    token = "Brown-fox9KJ2"
    steps = [(place[a], place[b]) for a, b in zip(token[:-1], token[1:], strict=True)]
    want = sum(math.log(chance[b]) - math.log(ordinary[a, b]) for a, b in steps) / len(steps)
    assert abs(model.of(token.encode()) - want) < 0.02  # texts' ends are not among the plain counts
