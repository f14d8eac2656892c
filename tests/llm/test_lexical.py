"""Ranked search of many queries against brute force."""

import math
import random
from collections import Counter

import pytest
from fixtures import odd_docs, odd_rows, sentence, symbol_words

from nearspark.llm import lexical


def by_hand(rows, items, k):
    docs = [(i, Counter(symbol_words(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    result = []
    for item, text in sorted(set(items), key=repr):
        scores = []
        for i, c, n in docs:
            m = 25 + 75 * n * total // length
            score = 0
            for term in symbol_words(text):
                if term in c:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * c[term] // (1000 * c[term] + 8 * m))
            if score:
                scores.append((-score, i is None, i or 0, i))
        scores.sort(key=lambda s: s[:3])
        result += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(scores[:k], 1)]
    return sorted(result, key=repr)


def tables(seed):
    rng = random.Random(seed)
    words = [f"t{int(40 * rng.random() ** 3)}" for _ in range(400)] + ["Été", "T1", "x-y"]
    rows = [(k, sentence(rng, rng.randint(0, 60), words)) for k in range(300)]
    items = [(k, sentence(rng, rng.randint(0, 25), words)) for k in range(30)]
    items += [(40, items[3][1] + " " + items[3][1]), (40, "t1 t2"), (41, None), (None, "t3 T3"), (5, items[5][1]), (42, "nowhere")]
    return rows + [(7, rows[7][1])] * 15 + [(None, "t1 t2 t2")] * 2 + [(900, None)], items


@pytest.mark.parametrize("seed,block,k", [(1, 100_000, 10), (2, 60, 3)])
def test_against_brute_force(spark, seed, block, k):
    rows, items = tables(seed)
    queries = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id int, text string, score int")
    got = lexical.search(odd_docs(spark, rows).repartition(3), queries, k, block_terms=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows, items, k)


def test_odd_and_empty(spark):
    queries = spark.createDataFrame([(1, "the stone river"), (2, "éclair w1 W2 w3"), (3, "nothing here")], "item_id long, text string")
    got = lexical.search(odd_docs(spark), queries)
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(odd_rows(), [tuple(r) for r in queries.collect()], 10)
    assert lexical.search(odd_docs(spark, []), queries).collect() == []
    assert lexical.search(odd_docs(spark), queries.limit(0)).collect() == []
    assert lexical.search(odd_docs(spark), queries.selectExpr("item_id", "null AS text")).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_shared_sums(seed):
    """Every query's nodes stand for its own leaves, once each, and fewer additions are left."""
    rng = random.Random(seed)
    sets = [rng.sample(range(60), rng.randint(2, 15)) for _ in range(8)]
    queries = [list(set(sum((rng.sample(sets, 3)), []))) for _ in range(40)] + [[], [7]]
    pairs, rest = lexical.share([list(q) for q in queries], 60)
    leaves = [Counter([n]) for n in range(60)]
    for a, b in pairs:
        leaves.append(leaves[a] + leaves[b])
    assert [sum((leaves[n] for n in nodes), Counter()) for nodes in rest] == [Counter(q) for q in queries]
    assert len(set(pairs)) == len(pairs)
    naive, shared = sum(len(q) for q in queries), len(pairs) + sum(len(nodes) for nodes in rest)
    assert shared < naive / 2
