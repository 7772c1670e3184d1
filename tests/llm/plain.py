"""Plain versions of operators, one text or pair after another."""

from collections import Counter
from math import exp, log

import numpy as np
import regex

from batchgate.llm import language_mixture as L


def grams(text):
    """The hashed n-grams of each word."""
    data = np.frombuffer(text.encode(), np.uint8)
    found, starts, _ = L.word_grams(data, np.array([0, len(data)]))
    cuts = [*starts.tolist(), len(found)]
    return [found[a:b].tolist() for a, b in zip(cuts, cuts[1:])]


class PlainMixture:
    """Counts, expectation-maximisation and choice of languages by loops over words."""

    def __init__(self, pairs):
        self.counts = {}
        for text, lang in pairs:
            held = self.counts.setdefault(lang, Counter())
            for word in grams(text):
                held.update(word)
        self.languages = sorted(k for k, v in self.counts.items() if v)
        size = 1 << L.GRAM_BITS
        self.totals = {k: sum(self.counts[k].values()) + L.SMOOTHING * size for k in self.languages}

    def _log_p(self, gram, lang):
        return log((self.counts[lang][gram] + L.SMOOTHING) / self.totals[lang])

    def _em(self, ratios, allowed):
        share = {k: 1 / len(allowed) for k in allowed}
        for _ in range(L.ROUNDS):
            total = dict.fromkeys(allowed, 0.0)
            for ratio in ratios:
                joint = {k: ratio[k] * share[k] for k in allowed}
                whole = sum(joint.values())
                for k in allowed:
                    total[k] += joint[k] / whole
            share = {k: t / len(ratios) for k, t in total.items()}
        return share, sum(log(sum(r[k] * share[k] for k in allowed)) for r in ratios)

    def shares(self, text):
        """Proportions of the languages chosen; none without words."""
        words = grams(text)
        if not words or not self.languages:
            return {}
        ratios = []
        for word in words:
            score = {k: sum(self._log_p(g, k) for g in word) for k in self.languages}
            best = max(score.values())
            ratios.append({k: exp(max(s - best, -300.0)) for k, s in score.items()})
        price = L.PENALTY * log(len(words) + 1) / 2
        alone = {k: sum(log(r[k]) for r in ratios) for k in self.languages}
        first = max(self.languages, key=lambda k: alone[k])
        chosen, value = {first: 1.0}, alone[first]
        order, _ = self._em(ratios, self.languages)
        ranked = sorted(self.languages, key=lambda k: -order[k])
        for size in range(2, len(ranked) + 1):
            share, fit = self._em(ratios, ranked[:size])
            if fit - price * (size - 1) > value:
                chosen, value = share, fit - price * (size - 1)
        return chosen


def lettered(text):
    return regex.search(r"\p{L}", text) is not None


def shingles(text, size):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def roots(sets, part, whole):
    """The smallest key that each key reaches by links."""
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if part * max(len(x), len(y)) > whole * min(len(x), len(y)):
                continue
            both = len(x & y)
            if whole * both >= part * (len(x) + len(y) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: find(k) for k in sets}
