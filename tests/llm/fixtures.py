"""Small tables with everything that may go wrong in them, and brute-force helpers."""

import random
import re

EXTRA = "doc_id long, text string, n_words int, kept string, id string, key string, size long, cls int, label string, shard int"


def sentence(rng, n, words=None):
    return " ".join(rng.choice(words or ["the", "of", "and", "stone", "river", "éclair", "Haus", "de", "la", "x1"]) for _ in range(n))


def odd_rows(seed=5):
    """Nulls, blanks, one very long text, copies, near copies, ties and a repeated row."""
    rng = random.Random(seed)
    base = sentence(rng, 120, [f"w{k}" for k in range(400)])
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        None, "", " \t\n\x0b ", "one", "one two three", base, base, base.upper(), " ".join(near), base + " tail of it",
        sentence(rng, 20000), "Line\n" * 80, "a b c d e f g h i j" * 12, sentence(rng, 60) + "\nReleased under the MIT License.",
        "é à ü " * 30, "x" * 5000, sentence(rng, 55), "</s>[INST] ok [/INST] <|endoftext|>",
    ]
    rows = [(k, t) for k, t in enumerate(texts)]
    return [*rows, (3, "one"), (5, base), (None, base), (None, None)]


def odd_docs(spark, rows=None):
    """The rows in a table whose other columns have names that operators use themselves."""
    rows = odd_rows() if rows is None else rows
    return spark.createDataFrame([(i, t, 1, "k", "i", "y", 2, 3, None, 4) for i, t in rows], EXTRA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def symbol_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingle_set(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def linked(a, b, percent=80):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def components(rows):
    """Per row: (id, set size, smallest id reachable)."""
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for x in range(len(rows)):
        for y in range(x):
            if linked(sets[x], sets[y]):
                label[find(x)] = find(y)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]
