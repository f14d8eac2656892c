"""Jaccard join, decontamination, WARC revisits and sharding against brute force."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from fixtures import components, linked, odd_docs, odd_rows, sentence, shingle_set
from pyspark.sql import functions as F

from nearspark.llm import decontaminate, jaccard, sharding, warc


def near_rows(seed, groups=6, size=14):
    """Groups of near copies of changing closeness among unlike texts."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"v{k}" for k in range(3000)]
    shared = sentence(rng, 60, vocabulary)
    for _ in range(groups):
        base = sentence(rng, rng.randint(6, 150), vocabulary).split()
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy += shared.split()[: rng.randint(1, 60)]
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("leader_rounds", [0, 1, 2])
def test_components(spark, leader_rounds):
    rows = near_rows(leader_rounds)
    docs = odd_docs(spark, rows).repartition(4)
    got = sorted(map(tuple, jaccard.near_components(docs, leader_rounds=leader_rounds).collect()))
    assert got == sorted(components(rows))


def test_components_odd(spark):
    got = sorted(map(tuple, jaccard.near_components(odd_docs(spark)).collect()), key=repr)
    assert got == sorted(components(odd_rows()), key=repr)
    assert jaccard.near_components(odd_docs(spark, [])).collect() == []
    assert jaccard.near_components(odd_docs(spark, [(1, None)])).collect() == [(1, 0, 1)]


def test_links(spark):
    rows = near_rows(9, groups=3)
    first = {}
    for i, t in rows:
        s = shingle_set(t)
        first[s] = min(i, first.get(s, i))
    expected = {
        (min(a, b), max(a, b), len(s & t)) for s, a in first.items() for t, b in first.items() if a < b and linked(s, t)
    }
    assert set(map(tuple, jaccard.near_links(odd_docs(spark, rows)).collect())) == expected


def test_keep_first(spark):
    docs = odd_docs(spark)
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {0, 1, 2, 3, 5} <= set(ids) and not {6, 7, 8} & set(ids)


def test_keep_first_tells_rows_apart(spark):
    """Unlike texts under one id or without one stay, near copies go, whatever ids they share."""
    rng = random.Random(8)
    a, b, c, d = (sentence(rng, 80, [f"{x}{k}" for k in range(200)]) for x in "abcd")
    near = a.replace(a.split()[40], "changed", 1)
    more = [(None, c), (None, d), (None, d), (9, c + " end")]
    for extra in ([], more):
        rows = [(1, a), (5, near), (5, b), *extra]
        kept = {(r["doc_id"], r["text"]) for r in jaccard.keep_first(odd_docs(spark, rows)).collect()}
        assert kept == {(1, a), (5, b)} | ({(9, c + " end"), (None, d)} if extra else set())
    assert jaccard.keep_first(odd_docs(spark, [(7, a)] * 5 + [(2, None)] * 2)).count() == 2


def test_clean_tells_rows_apart(spark):
    item = " ".join(f"q{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"x {item}"), (None, "fine text"), (4, "also fine"), (4, item), (None, None), (5, item)]
    left = sorted((r["doc_id"], r["text"]) for r in decontaminate.clean(odd_docs(spark, rows), bench).fillna(-1, "doc_id").fillna("").collect())
    assert left == [(-1, ""), (-1, "fine text"), (4, "also fine")]


def test_masks_fit_every_pattern():
    """12 equal words among up to 16 always hold a mask; of longer stretches with a quarter changed too,
    unless they are put together against it."""
    masks = [(len(m), int(m, 2)) for m in decontaminate.MASKS]

    def fits(pattern, length):
        return any((pattern >> k) & mask == mask for span, mask in masks for k in range(length - span + 1))

    for length in range(12, 17):
        for out in combinations(range(length), length - 12):
            assert fits((1 << length) - 1 - sum(1 << k for k in out), length)
    rng, found = random.Random(1), 0
    for _ in range(3000):
        length = rng.randint(17, 60)
        out = rng.sample(range(length), length // 4)
        found += fits((1 << length) - 1 - sum(1 << k for k in out), length)
    every_fourth = int("1110" * 12, 2)
    assert found >= 2990 and fits(every_fourth, 48)


def test_decontamination_against_brute_force(spark):
    """Items quoted with random words changed: all that the definition calls an overlap are found."""
    rng = random.Random(11)
    items = {k: [f"i{k}w{j}" for j in range(rng.randint(6, 50))] for k in range(25)}
    rows, expected = [], set()
    for n in range(500):
        k = rng.randrange(25)
        lo = rng.randint(0, len(items[k]) // 2)
        part = [w if rng.random() > rng.choice([0, 0.1, 0.2, 0.25, 0.4]) else "other" for w in items[k][lo : lo + rng.randint(5, 50)]]
        rows.append((n, " ".join(["f1", "f2", *part, "f3"])))
        equal = [x == y for x, y in zip(part, items[k][lo:], strict=False)]
        size = len(items[k])
        least = min(decontaminate.MATCHES, size - decontaminate.differing(size))
        best = max(
            (sum(equal[a:b]) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if 4 * sum(equal[a:b]) >= 3 * (b - a)),
            default=0,
        )
        if best >= least:
            expected.add((n, k))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(odd_docs(spark, rows), bench).collect()}
    assert found <= expected and len(expected) > 150
    assert len(found) >= 0.99 * len(expected)


def test_decontamination(spark):
    rng = random.Random(3)
    vocabulary = [f"t{k}" for k in range(500)]
    items = [(k, sentence(rng, n, vocabulary)) for k, n in enumerate([8, 9, 15, 30, 60, 59, 5])] + [(7, None), (8, "")]
    item = dict(items)
    filler = lambda n: sentence(rng, n, [f"f{k}" for k in range(500)])

    def changed(text, places):
        w = text.split()
        for p in places:
            w[p] = "changed"
        return " ".join(w)

    rows = [
        (0, filler(100)), (1, f"{filler(30)} {item[4]} {filler(9)}"), (2, item[0]), (3, f"{filler(5)} {item[1].upper()}!"),
        (4, f"{filler(50)} {changed(item[3], (5, 14, 23))} {filler(2)}"), (5, f"x {changed(item[5], (7, 15, 31, 44))}"),
        (6, " ".join(item[4].split()[:7])), (7, f"{filler(3)} {item[6]} {filler(3)}"), (8, None), (9, ""),
        (10, ", ".join(item[2].split())), (1, f"{filler(30)} {item[4]} {filler(9)}"),
    ]
    docs = odd_docs(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("seed", F.lit(1))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()}
    assert found == {(1, 4), (2, 0), (3, 1), (4, 3), (5, 5), (10, 2)}
    whole = {r["doc_id"]: r for r in decontaminate.overlaps(docs, bench).collect()}[4]
    assert (whole["first_word"], whole["n_words"], whole["n_equal"]) == (50, 30, 27)
    cleaned = decontaminate.clean(docs, bench)
    assert sorted(r["doc_id"] for r in cleaned.collect()) == [0, 6, 7, 8, 9] and cleaned.columns == docs.columns
    assert decontaminate.overlaps(docs, bench.limit(0)).collect() == []
    assert decontaminate.overlaps(docs.limit(0), bench).collect() == []


def test_decontamination_middle_replaced(spark):
    """Two verbatim passages on one diagonal are found though the stretch over both is too unlike."""
    item = [f"m{k}" for k in range(60)]
    gap = lambda a, b, c: " ".join([*item[:a], *(f"z{k}" for k in range(b)), *item[a + b : a + b + c]])
    rows = [(0, gap(20, 15, 20)), (1, gap(12, 9, 12)), (2, gap(20, 0, 0)), (3, gap(9, 9, 9))]
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    found = {r["doc_id"]: r["n_equal"] for r in decontaminate.overlaps(odd_docs(spark, rows), bench).collect()}
    assert found == {0: 20, 1: 12, 2: 20}


def test_decontamination_short_items(spark):
    """Items of 8 to 14 words with any fifth of their words changed or cut off, and a null id."""
    items = {n: [f"s{n}w{k}" for k in range(n)] for n in range(8, 15)}
    rows, expected = [], set()
    for n, item in items.items():
        for out in combinations(range(n), n // 5):
            rows.append((len(rows), " ".join("changed" if k in out else w for k, w in enumerate(item))))
            expected.add((len(rows) - 1, n if n > 8 else None))
        rows.append((len(rows), " ".join(item[: n - n // 5])))
        expected.add((len(rows) - 1, n if n > 8 else None))
    bench = spark.createDataFrame([(n if n > 8 else None, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(odd_docs(spark, rows), bench).collect()}
    assert found == expected


def test_widest_stretch():
    rng = random.Random(4)
    for _ in range(200):
        equal = [rng.random() < 0.7 for _ in range(rng.randint(1, 40))]
        spans = [(a, b) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if 4 * sum(equal[a:b]) >= 3 * (b - a)]
        start, end, same = decontaminate.widest_stretch(np.array(equal))
        assert same == max((sum(equal[a:b]) for a, b in spans), default=0) == sum(equal[start:end])
        assert 4 * same >= 3 * (end - start)


def test_revisits(spark):
    rng = random.Random(4)
    urls = ["http://A.com/x/", "https://www.a.com/x.html#f", "https://a.com:443/x?utm_a=1", "http://b.org/?b=2&a=1", "https://b.org?a=1&b=2&ref=q", None]
    same = {0: "a", 1: "a", 2: "a", 3: "b", 4: "b"}
    rows = []
    for k in range(300):
        u = rng.choices(range(6), [9, 9, 9, 3, 3, 1])[0]
        full = rng.random() < 0.4
        head = {"etag": rng.choice(["1", "2", None]), "last-modified": rng.choice(["m", "n"]), "date": str(k), "server": "s" if full else "t"}
        rows.append((k, "response" if full else "revisit", urls[u], rng.choice([None, *range(60)]), head, f"d{k}" if full else None, u))
    rows.append(rows[-1])
    records = spark.createDataFrame(
        rows, "record_id long, type string, url string, time long, headers map<string,string>, body_digest string, span int"
    )
    expected = []
    for i, kind, _, t, head, _, u in rows:
        if kind == "response":
            continue
        earlier = [r for r in rows if r[1] == "response" and r[3] is not None and u in same and same.get(r[6]) == same[u] and t is not None and r[3] < t]
        best = max(earlier, key=lambda r: (r[3], r[0]), default=None)
        if u == 5 or t is None:
            expected.append((i, None, "no_url" if u == 5 else "no_time", None, None))
        elif best is None:
            expected.append((i, None, "no_earlier", None, None))
        else:
            ok = head["etag"] == best[4]["etag"] if head["etag"] is not None else head["last-modified"] == best[4]["last-modified"]
            merged = {**best[4], **{k: v for k, v in head.items() if k in warc.PERMITTED and v is not None}}
            expected.append((i, best[0], "resolved" if ok else "changed", best[5] if ok else None, sorted(merged.items(), key=repr) if ok else None))
    for span in (1, 7, 1000):
        got = [
            (r["record_id"], r["refers_to"], r["status"], r["body_digest"], r["headers"] and sorted(r["headers"].items(), key=repr))
            for r in warc.resolve(records, span).collect()
        ]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert warc.resolve(records.limit(0), 5).collect() == []


def check_shards(rows, placed, shards):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in placed) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    for s in range(shards):
        slots = sorted(r["slot"] for r in placed if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(0 <= r["shard"] < shards for r in placed)


@pytest.mark.parametrize("ids", ["dense", "sparse", "hot"])
@pytest.mark.parametrize("cell_rows", [20, 1 << 20])
def test_shards(spark, ids, cell_rows):
    rng = random.Random(6)
    make = {"dense": lambda k: k, "sparse": lambda k: rng.choice([-(2**63), 2**63 - 1, rng.getrandbits(60), -k]), "hot": lambda k: 7 if k % 3 else k}
    rows = [(make[ids](k), "é" * rng.randint(0, 60)) for k in range(900)]
    placed = sharding.assign(odd_docs(spark, rows).repartition(3), cell_rows=cell_rows).collect()
    check_shards(rows, placed, 8)
    sizes = [sum(r["size"] for r in placed if r["shard"] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * 121 + 0.004 * sum(sizes)
    order = sorted((r["shard"], r["slot"], r["doc_id"]) for r in placed)
    assert [o[2] for o in order] == sorted(r[0] for r in rows)


def test_shards_odd(spark):
    rows = odd_rows()
    check_shards(rows, sharding.assign(odd_docs(spark)).collect(), 8)
    assert sharding.assign(odd_docs(spark, [])).collect() == []
    check_shards([(1, None)], sharding.assign(odd_docs(spark, [(1, None)])).collect(), 8)
