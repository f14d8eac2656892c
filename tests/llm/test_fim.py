"""Fill-in-the-middle outputs against texts put together by hand."""

import hashlib
import random

import pytest
from fixtures import odd_docs, odd_rows

from nearspark.llm import fim


def by_hand(id_, text):
    """(n, form, a, b, output) of one row."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if id_ is None else id_}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b, f"<P>{p}<S>{s}<M>{m}"


def rows():
    more = ["a<P>b", "<<S", "<M", "𝄞é<" * 40, "<" * 50, ">P<" * 30, "S>" * 9, "x" * (3 * fim.UNIT + 1)]
    odd = odd_rows()
    return odd + [(100 + 7 * k, t) for k, t in enumerate(more * 4)] + odd[:8]


def test_digests(spark):
    expected = []
    for id_, text in rows():
        n, form, a, b, output = by_hand(id_, text)
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (output, text or "")]
        expected.append((id_, n, form, a, None if a is None else b - a, *sha))
    got = fim.digests(odd_docs(spark, rows()).repartition(3))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
    assert {"plain", "psm", "spm"} == {e[2] for e in expected}


def test_pieces_make_the_outputs(spark):
    docs = odd_docs(spark, rows()).repartition(3)
    texts = {}
    for r in fim.pieces(docs).collect():
        texts.setdefault((r["row_key"], r["doc_id"], r["form"], r["copies"]), {})[r["place"]] = r["piece"]
    got = []
    for (_, id_, form, copies), parts in texts.items():
        got += [(id_, form, "".join(parts[p] for p in sorted(parts)))] * copies
    expected = [(i, by_hand(i, t)[1], by_hand(i, t)[4]) for i, t in rows()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_empty(spark):
    assert fim.digests(odd_docs(spark, [])).collect() == []
    assert fim.pieces(odd_docs(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_parse_reads_marks_across_pieces(seed):
    rng = random.Random(seed)
    while True:
        parts = {name: "".join(rng.choice("<>PSMx") for _ in range(rng.randint(0, 9))) for name in fim.PLACE}
        text = parts["prefix"] + parts["middle"] + parts["suffix"]
        if text and not any(mark in text for mark in fim.MARK.values()):
            break
    for form, order in fim.ORDER.items():
        output = "".join(fim.MARK[name] + parts[name] for name in order)
        cuts = sorted(rng.randint(0, len(output)) for _ in range(5))
        pieces = [output[i:j] for i, j in zip([0, *cuts], [*cuts, len(output)], strict=True)]
        back = dict.fromkeys(fim.PLACE, "")
        for part, piece in fim.parse(pieces, form):
            back[part] += piece
        assert back == parts


def test_one_exchange(spark):
    plan = fim.digests(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort") == 2
