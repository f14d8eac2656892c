"""Removal of repeated passages against brute force."""

import random
import re

import numpy as np
import pytest
from fixtures import odd_docs, odd_rows

from nearspark.llm import repeats
from nearspark.llm.words import Ranges, rightmost_least


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_hand(rows, size):
    least = {}
    for id_, text in rows:
        w = split(text)
        for k in range(len(w) - size + 1):
            if id_ is not None:
                window = tuple(w[k : k + size])
                least[window] = min(id_, least.get(window, id_))
    result = []
    for id_, text in rows:
        w = split(text)
        gone = set()
        for k in range(len(w) - size + 1):
            if id_ is not None and least[tuple(w[k : k + size])] < id_:
                gone.update(range(k, k + size))
        result.append((id_, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(result, key=repr)


def passages(seed, vocabulary):
    """Texts made of common passages, copies with edits, and words that repeat a lot."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["W1", "é"]
    common = [[rng.choice(words) for _ in range(rng.randint(5, 40))] for _ in range(5)]
    texts = []
    for _ in range(60):
        text = []
        for _ in range(rng.randint(0, 4)):
            part = list(rng.choice(common)) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 30))]
            if rng.random() < 0.3:
                part[rng.randrange(len(part))] = rng.choice(words)
            text += part[rng.randint(0, 4) if rng.random() < 0.3 else 0 :]
        texts.append(text)
    texts += [["w1"] * n for n in (3, 9, 30, 30)]
    texts += [list(texts[3]) for _ in range(20)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, rng.choice([" ", "\n ", "\t"]).join(t)) for i, t in zip(ids, texts, strict=True)]
    return rows + rows[:3] + [(None, rows[5][1]), (rows[1][0], rows[6][1])]


@pytest.mark.parametrize("seed,vocabulary,size,anchor", [(1, 500, 8, 3), (2, 3, 8, 3), (3, 20, 6, 6), (4, 100, 10, 1)])
def test_against_brute_force(spark, seed, vocabulary, size, anchor):
    rows = passages(seed, vocabulary)
    got = repeats.remove_repeats(odd_docs(spark, rows).repartition(3), size, anchor)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    expected = by_hand(rows, size)
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert any(e[2] for e in expected)


def test_odd_and_empty(spark):
    got = repeats.remove_repeats(odd_docs(spark))
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(odd_rows(), repeats.SIZE)
    assert repeats.remove_repeats(odd_docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(odd_docs(spark), 5, 6)


def test_parts():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 200).astype(np.uint64)
    for size in (1, 2, 3, 7, 31):
        places = [max(range(j, j + size), key=lambda p: (-int(values[p]), p)) for j in range(200 - size + 1)]
        assert rightmost_least(values, size).tolist() == places
    hashes = np.tile(rng.integers(0, 2**63, 40).astype(np.uint64), 3)
    ranges = Ranges(hashes)
    lo, hi = np.array([0, 40, 80, 0, 1]), np.array([30, 70, 110, 29, 31])
    h = ranges(lo, hi)
    assert h[0] == h[1] == h[2] and len(set(h.tolist())) == 3
    assert repeats.covered([(0, 2), (1, 3), (5, 6)], 7).tolist() == [True, True, True, False, False, True, False]
