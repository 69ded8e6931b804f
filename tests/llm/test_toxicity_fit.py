"""The factorization machine against explicit pairs, and the interactions it must find."""

import random

import numpy as np
import pytest

from cartscope.llm import toxicity


def sparse(docs, labels):
    places, cut, feature = {}, [0], []
    for d in docs:
        feature += sorted({places.setdefault(w, len(places)) for w in d})
        cut.append(len(feature))
    return toxicity.Rows(np.array(cut), np.array(feature), np.array(labels, float), np.ones(len(labels))), len(places)


def auc(z, y):
    rank = np.empty(len(z))
    rank[np.argsort(z)] = np.arange(1, len(z) + 1)
    n = (y > 0).sum()
    return (rank[y > 0].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def held_out(docs, labels, factors=toxicity.FACTORS):
    x, n = sparse(docs, labels)
    cut = len(labels) * 3 // 4
    state = toxicity.fit_rows(x.pick(np.arange(cut)), n, factors)
    rest = x.pick(np.arange(cut, len(labels)))
    return auc(toxicity._logits(rest, *state)[0], rest.label)


def exactly_one(noise, size, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for _ in range(size):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append([f"w{rng.randint(0, noise)}" for _ in range(12)] + ["a"] * a + ["b"] * b)
        labels.append(int(a != b))
    return docs, labels


def test_score_equals_explicit_pairs():
    rng = np.random.default_rng(1)
    place = np.full(1 << toxicity.BITS, -1, np.int32)
    place[:40] = rng.permutation(40)
    machine = toxicity.FactorizationMachine(place, -0.3, rng.normal(size=40), rng.normal(size=(40, 8)))
    docs = [[], [3], [1, 2, 5], list(range(0, 45, 3))]  # 42 is unused
    doc = np.repeat(np.arange(4), [len(d) for d in docs])
    got = machine.score(doc, np.array(sum(docs, [])), 4)
    for d, s in zip(docs, got):
        f = [place[k] for k in d if place[k] >= 0]
        z = -0.3 + sum(machine.weights[i] for i in f)
        z += sum(machine.factors[i] @ machine.factors[j] for n, i in enumerate(f) for j in f[:n])
        assert s == pytest.approx(1 / (1 + np.exp(-z)))


@pytest.mark.parametrize("noise, least", [(200, 0.9), (4000, 0.8)])
def test_a_pair_whose_words_tell_nothing_alone(noise, least):
    for seed in (1, 2):
        docs, labels = exactly_one(noise, 8000, seed)
        assert held_out(docs, labels) >= least
    assert held_out(docs, labels, factors=0) <= 0.56  # weights alone can't tell


def test_insults_with_groups_beat_weights_alone():
    rng = random.Random(5)
    docs, labels = [], []
    for _ in range(8000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append([f"w{rng.randint(0, 300)}" for _ in range(10)] + [f"i{rng.randint(0, 29)}"] * a
                    + [f"g{rng.randint(0, 29)}"] * b)
        labels.append(int(a == b))
    assert held_out(docs, labels) >= held_out(docs, labels, factors=0) + 0.2
