"""Learned operators against plain loops: exhaustive language sets, and the risk against the true distribution."""

import itertools
import math
import random

import numpy as np
import pytest

from starloom.llm import language, quality


def proportions(words, languages):
    """EM by a plain loop until it settles, and the log likelihood."""
    shares = {k: 1 / len(languages) for k in languages}
    for _ in range(2000):
        new = dict.fromkeys(languages, 0.0)
        for word in words:
            total = sum(shares[k] * word[k] for k in languages)
            for k in languages:
                new[k] += shares[k] * word[k] / total / len(words)
        settled = max(abs(new[k] - shares[k]) for k in languages) < 1e-9
        shares = new
        if settled:
            break
    return shares, sum(math.log(sum(shares[k] * w[k] for k in languages)) for w in words)


def mixed_text(rng, languages, most, low, high):
    """Log likelihoods of words that are mixed from some of the languages; ``low`` to ``high``: how much clearer the own one is."""
    mix = [rng.choice([0, 0, 1, 2]) for _ in range(languages)]
    mix[0] += not sum(mix)
    owners = rng.choices(range(languages), mix, k=rng.randint(1, most))
    return np.array([[rng.gauss(0, 1) + (rng.uniform(low, high) if k == own else 0) for k in range(languages)] for own in owners], np.float32)


@pytest.mark.parametrize(("low", "high", "slack"), [(1, 6, 0.01), (0.2, 3, 1.0)])
def test_language_sets_against_every_set(low, high, slack):
    """Clear words: the best of all sets.  Words that hardly tell languages apart: within ``slack`` of its criterion."""
    rng = random.Random(3)
    texts = [mixed_text(rng, 4, 40, low, high) for _ in range(80)]
    together = language.mixtures(np.concatenate(texts), np.array([len(t) for t in texts]))
    for logs, shares in zip(texts, together):
        words = np.exp(logs - logs.max(axis=1, keepdims=True)).tolist()
        fits = {}
        for size in range(1, 5):
            for chosen in itertools.combinations(range(4), size):
                own, likelihood = proportions(words, chosen)
                fits[chosen] = -2 * likelihood + size * math.log(max(len(words), 2)), own
        best = min(fits, key=lambda c: fits[c][0])
        found = tuple(int(k) for k in np.flatnonzero(shares))
        assert fits[found][0] - fits[best][0] <= slack
        if slack < 1:
            own = fits[found][1]
            assert max(own, key=own.get) == int(shares.argmax())
            assert max(abs(own[k] - shares[k]) for k in found) < 0.05
        assert abs(shares.sum() - 1) < 1e-5


def test_texts_of_a_batch_do_not_meet():
    rng = random.Random(5)
    texts = [mixed_text(rng, 3, 30, 0.5, 4) for _ in range(20)]
    together = language.mixtures(np.concatenate(texts), np.array([len(t) for t in texts]))
    for logs, shares in zip(texts, together):
        assert np.allclose(language.mixtures(logs, np.array([len(logs)]))[0], shares, atol=1e-5)


PRIOR = 0.4


def odds(x):
    """The true chance of a positive: it is shifted by 2.5 in the first place."""
    own = PRIOR * np.exp(-((x[:, 0] - 2.5) ** 2) / 2)
    return own / (own + (1 - PRIOR) * np.exp(-(x[:, 0] ** 2) / 2))


def risk(positive, unlabelled):
    """The non-negative unbiased risk of chances, as it is defined."""
    negative = -np.log(1 - unlabelled).mean() - PRIOR * -np.log(1 - positive).mean()
    return PRIOR * -np.log(positive).mean() + max(0, negative)


def test_fit_minimises_the_risk_and_finds_the_true_chances():
    rng = np.random.default_rng(1)
    truth = rng.random(6000) < PRIOR
    mixed, positive = rng.normal(0, 1, (6000, 3)), rng.normal(0, 1, (800, 3))
    mixed[truth, 0] += 2.5
    positive[:, 0] += 2.5
    model = quality.fit(positive, mixed, PRIOR)
    scores = model.scores(mixed)
    assert risk(model.scores(positive), scores) <= risk(odds(positive), odds(mixed)) + 0.01
    assert risk(model.scores(positive), scores) < 0.6 * risk(np.full(800, PRIOR), np.full(6000, PRIOR))
    assert np.abs(scores - odds(mixed)).mean() < 0.06
    assert ((scores > 0.5) == truth).mean() > ((odds(mixed) > 0.5) == truth).mean() - 0.01
    # no labels of the negative kind were seen; a fit against the same rows as if all were negative is much worse
    naive = quality.fit(positive, mixed, 800 / 6800).scores(mixed)
    assert np.abs(naive - odds(mixed)).mean() > 2 * np.abs(scores - odds(mixed)).mean()
    assert abs(quality.estimated_prior(positive, mixed) - PRIOR) < 0.1
