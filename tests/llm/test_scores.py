"""Suffix-tree scores against a plain reading of the definition."""

import collections
import math
import random
import zlib

import pytest
from fixtures import odd_docs, odd_rows, words

from nearspark.llm import pst

END = "\n"


def tokens(text):
    return [*words(text), END]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts, depth, least, divergence):
        self.depth = depth
        count = collections.Counter()
        for t in texts:
            w = tokens(t)
            for n in range(1, depth + 2):
                count.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        self.unigrams = {g[0]: c for g, c in count.items() if len(g) == 1}
        self.total = sum(self.unigrams.values())
        self.least = least(self.total)
        frequent = {g: c for g, c in count.items() if c >= self.least}
        self.states = {}
        for n in range(1, depth + 1):
            for s in [g for g in frequent if len(g) == n]:
                nexts = {g[-1]: c for g, c in frequent.items() if g[:-1] == s}
                if not nexts:
                    continue
                own = {w: (c - pst.DISCOUNT) / frequent[s] for w, c in nexts.items()}
                old = {w: self.chance(s[1:], w) for w in nexts}
                rest, old_rest = max(1 - sum(own.values()), 1e-12), max(1 - sum(old.values()), 1e-12)
                far = sum(p * math.log(p / old[w]) for w, p in own.items()) + rest * math.log(rest / old_rest)
                if far >= divergence:
                    self.states[s] = (own, rest / old_rest)

    def chance(self, context, w):
        if not context:
            return (self.unigrams.get(w, 0) + 0.5) / (self.total + 0.5 * (len(self.unigrams) + 1))
        if context in self.states:
            own, backoff = self.states[context]
            return own[w] if w in own else backoff * self.chance(context[1:], w)
        return self.chance(context[1:], w)

    def scores(self, text):
        w = tokens(text)
        base = sum(math.log10(self.chance((), x)) for x in w)
        full = sum(math.log10(self.chance(tuple(w[max(0, i - self.depth) : i]), x)) for i, x in enumerate(w))
        return len(w), sum(x in self.unigrams for x in w), base, full


def check(rows, got, plain):
    got = sorted((r["doc_id"] is not None, r["doc_id"], round(r["base_score"], 6), r) for r in got)
    expected = sorted(
        ((i is not None, i, round(plain.scores(t)[2], 6), plain.scores(t)) for i, t in rows), key=lambda x: (x[0], x[1] or 0, x[2])
    )
    for (_, i, _, r), (_, j, _, (n, known, base, full)) in zip(got, expected, strict=True):
        assert i == j and r["held_out"] == is_held(i)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, plain.total)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(full)


@pytest.mark.parametrize("depth", [1, 3])
def test_scores(spark, depth):
    rng, rows = random.Random(depth), []
    for k in range(150):
        w = [rng.choice("abcdefgh")]
        for _ in range(rng.randint(0, 60)):
            w.append(rng.choice("bc") if w[-1] == "a" else rng.choice(["a", "b", "C", "d", f"r{rng.randint(0, 300)}"]))
        rows.append((k, " ".join(w)))
    settings = {"min_share": 0.004, "min_count": 3, "divergence": 0.02}
    got = pst.score(odd_docs(spark, rows).repartition(3), depth=depth, **settings).collect()
    plain = Plain([t for i, t in rows if not is_held(i)], depth, lambda n: max(3, math.ceil(0.004 * n)), 0.02)
    assert plain.states
    check(rows, got, plain)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    contexts = [(), *plain.states]
    for s in contexts:  # every distribution adds up to one, the unknown word included
        assert sum(plain.chance(s, w) for w in [*plain.unigrams, "unknown"]) == pytest.approx(1)


def test_odd(spark):
    rows = [(i, t) for i, t in odd_rows() if len(t or "") < 20000]
    got = pst.score(odd_docs(spark, rows)).collect()
    plain = Plain([t for i, t in rows if not is_held(i)], pst.DEPTH, lambda n: max(pst.MIN_COUNT, math.ceil(pst.MIN_SHARE * n)), pst.DIVERGENCE)
    check(rows, got, plain)
    assert pst.score(odd_docs(spark, [])).collect() == []


def test_no_training_rows(spark):
    held = next(i for i in range(100) if is_held(i))
    row = pst.score(odd_docs(spark, [(held, "a b")])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)


def test_counts_do_not_grow_with_the_corpus(spark):
    """A context seen a few times counts, however many other tokens there are."""
    rows = [(k, " ".join(f"n{k}x{i}" for i in range(5000))) for k in range(160)]
    rows += [(1000 + k, "stone over river goes") for k in range(10)]
    held = next(i for i in range(2000, 2100) if is_held(i))
    rows.append((held, "stone over river goes"))
    got = pst.score(odd_docs(spark, rows))
    row = got.filter(f"doc_id = {held}").first()
    plain = Plain([t for i, t in rows if not is_held(i)], pst.DEPTH, lambda n: pst.MIN_COUNT, pst.DIVERGENCE)
    assert pst.MIN_COUNT < 10 < 2e-5 * plain.total and ("stone",) in plain.states
    assert row["score"] == pytest.approx(plain.scores("stone over river goes")[3])


def test_hot_words_are_a_share_of_the_corpus(spark):
    """Five times the corpus sends five times the words through the exchange, not words that the table was too small for."""
    outside = []
    for copies in (1, 5):
        texts = [(" ".join([f"n{k}x{i}" for i in range(4000)] + ["stone"] * 1000),) for k in range(80)] * copies
        tree = pst.learn(spark.createDataFrame(texts, "text string"))
        names = pst._hot(tree).words.names
        hot = spark.createDataFrame([(int(x),) for x in names.view("int64")], "gram long")
        outside.append(tree.weights.filter("known > 0").join(hot, "gram", "left_anti").agg({"count": "sum"}).first()[0])
    assert outside == [80 * 4000, 5 * 80 * 4000]
    assert 0 < len(names) <= 1 / pst.HOT_SHARE


@pytest.mark.parametrize("share", [0.002, 0.05, 2.0])
def test_cold_grams(spark, monkeypatch, share):
    """Scores do not depend on which n-grams are hot; texts repeat, and some share an id."""
    monkeypatch.setattr(pst, "HOT_SHARE", share)
    rng = random.Random(7)
    rows = [(k % 90, " ".join(rng.choice(["a", "b c", "d e f", f"r{rng.randint(0, 200)}"]) for _ in range(rng.randint(0, 50)))) for k in range(120)]
    rows += [*rows[:10], (None, "d e f d e f")]
    got = pst.score(odd_docs(spark, rows)).collect()
    plain = Plain([t for i, t in rows if not is_held(i)], pst.DEPTH, lambda n: pst.MIN_COUNT, pst.DIVERGENCE)
    assert any(len(s) == pst.DEPTH for s in plain.states)
    check(rows, got, plain)
