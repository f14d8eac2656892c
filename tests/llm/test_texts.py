"""Quality rules, licenses, URLs, BPE and chat formatting on odd tables."""

import hashlib
import os
import random

import duckdb
import pytest
from fixtures import odd_docs, odd_rows, sentence
from pyspark.sql import functions as F

import public_tokenizers
from nearspark.llm import bpe, chat, licenses, plans, quality, urls


def by_id(rows, key="doc_id"):
    return sorted((tuple(r) for r in rows), key=repr)


def unique_rows():
    seen, rows = set(), []
    for i, t in odd_rows():
        if i is not None and i not in seen:
            seen.add(i)
            rows.append((i, t))
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A driver-like folder made of the odd rows with unique ids."""
    base = tmp_path_factory.mktemp("tables")
    odd_docs(spark, unique_rows()).coalesce(1).write.parquet(str(base / "documents.parquet"))
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "<|im_end|> \\ <\\s> </s>"), (1, 3, "assistant", "b[INST]"),
        (2, 0, "assistant", "only"), (3, 0, "user", ""), (4, 1, "assistant", "tie"), (4, 1, "assistant", "tie"), (4, 1, "user", "tie"),
    ]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(
        str(base / "conversations.parquet")
    )
    return str(base)


@pytest.mark.parametrize("name", ["op1_ngram_jaccard", "op2_license_scan", "op6_chat_format", "op9_quality_rules"])
def test_against_sql(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    expected = db.sql(plans.ORACLES[name])
    result = plans.QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    place = [expected.columns.index(c) for c in columns]
    assert by_id(result.select(*columns).collect()) == by_id(tuple(r[p] for p in place) for r in expected.fetchall())


@pytest.mark.parametrize("operator", [
    lambda d: quality.judge(d), lambda d: licenses.scan(d), lambda d: quality.accepted(d),
    lambda d: bpe.digests(d, public_tokenizers.path("byte_bpe_50k.json")),
])
def test_odd_and_empty(spark, operator):
    docs = odd_docs(spark)
    result = operator(docs).collect()
    assert 0 < len(result) <= docs.count()
    empty = operator(odd_docs(spark, []))
    assert empty.collect() == []


def test_quality_defaults(spark):
    rows = {r["doc_id"]: r for r in quality.judge(odd_docs(spark, unique_rows())).collect()}
    assert rows[0]["n_words"] == 0 and rows[0]["base_failed"] and not rows[0]["kept"]
    assert rows[11]["n_dup_lines"] == 79 and rows[11]["n_repeat_words"] == 80 and rows[11]["base_failed"]
    assert rows[5]["kept"] is False  # no stop word in it
    kept = quality.accepted(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns


def test_quality_filters_and_languages(spark):
    """The verdict can be filtered on, and languages without a list are not held to it."""
    text = " ".join(f"sana{k} lause{k}" for k in range(300))
    docs = spark.createDataFrame(
        [(1, text, "fi"), (2, text, "en"), (3, text, None), (4, text + " the of and" * 40, "en"), (5, "x", "fi")],
        "doc_id long, text string, lang string",
    )
    assert sorted(r[0] for r in quality.accepted(docs).collect()) == [1, 3, 4]
    assert [r[0] for r in quality.judge(docs).filter("kept").collect()] == [4]
    assert quality.judge(docs).filter("n_repeat_words > 0").select("doc_id").count() == 1


def test_licenses_find_wrapped_templates(spark):
    text = "foo " * 40 + "Permission is hereby\ngranted, free of charge, to any person obtaining a copy of this program " + "bar " * 40
    docs = spark.createDataFrame([(1, text), (2, "permission of the person"), (3, "CC BY CC-BY cc by")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert rows[1]["labels"] == "mit" and rows[1]["n_base"] == 0 and rows[1]["score"] == pytest.approx(14 / 15)
    assert rows[2]["labels"] == "" and rows[2]["score"] == 0.0
    assert (rows[3]["n_base"], rows[3]["first_word"], rows[3]["last_word"], rows[3]["base_labels"]) == (3, 0, 4, "cc-by")


LABELS = [
    ("Licensed under CC BY 4.0", "cc-by"), ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
    ("under the terms of the GNU General Public License", "gpl"), ("under the terms of the GNU Lesser General Public License", "lgpl"),
    ("released under the Apache License", "apache"), ("released under the MIT License", "mit"), ("released under the terms of it", ""),
    ("you can redistribute it and/or modify it under the terms of the license version 2", ""),
    ("subject to the terms of the Mozilla Public License", "mpl"), ("subject to the terms of the public license of it", ""),
    ("redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
]


def test_licenses_tell_deciding_words(spark):
    rows = [(k, f"{'foo ' * k}{text} {'bar ' * 50}") for k, (text, _) in enumerate(LABELS)]
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[k] for k in range(len(rows))] == [labels for _, labels in LABELS]


def test_licenses_against_brute_force(spark):
    """All blocks of shuffled template words, whatever filters leave out."""
    rng, vocabulary = random.Random(4), sorted({w for _, ws in licenses.template_sets() for w in ws})
    rows, expected = [], set()
    for k in range(150):
        words = [rng.choice(vocabulary + ["x"] * 20) for _ in range(rng.randint(0, 90))]
        words += [w for w in rng.choice(licenses.template_sets())[1] if rng.random() < 0.93]
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
    for k, text in rows:
        words = text.split()
        for b in range(1 + max(0, -(-(len(words) - licenses.BLOCK) // (licenses.BLOCK // 2)))):
            content = set(words[b * licenses.BLOCK // 2 : b * licenses.BLOCK // 2 + licenses.BLOCK])
            for t, ((_, ws), own) in enumerate(zip(licenses.template_sets(), licenses.marks(), strict=True)):
                enough = len(content & set(ws)) >= licenses.needed(len(ws), licenses.THRESHOLD)
                if enough and len(content & set(own)) >= (licenses.needed(len(own), licenses.THRESHOLD) if own else 0):
                    expected.add((k, b, t))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "blocks").collect()
    assert {(r["doc_id"], x["block"], x["template"]) for r in got for x in r["blocks"]} == expected and len(expected) > 50


URLS = [
    (1, "http://A.Example.COM/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    (2, "https://www.example.com/en/x?y", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (3, "https://x.net/fr/", "x.net", "/fr/", "net/fr/", "block"),
    (4, "https://x.net/de/#f", "x.net", "/de/", None, None),
    (5, "https://com/", "com", "/", "com/", "allow"),
    (6, "https://telecom/", "telecom", "/", None, None),
    (7, None, "", "", None, None),
    (8, "no scheme", "", "", None, None),
    (9, "x://net", "net", "", None, None),
    (10, "http://h?a://b/c", "h", "", None, None),
    (10, "http://h?a://b/c", "h", "", None, None),
]


RULES_SQL = """
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS given, substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1) AS rest FROM p),
u AS (
  SELECT page_id, translate(given, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^?#]*') AS path FROM h),
rules AS (
  SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS t(site, start, what)),
m AS (
  SELECT page_id, arg_max(site || start, length(site || start)) AS rule, arg_max(what, length(site || start)) AS what
  FROM u JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, start) GROUP BY page_id)
SELECT page_id, host, path, rule, what FROM u LEFT JOIN m USING (page_id)"""


def test_urls_against_sql(spark, tmp_path):
    """Host, path and rule of random urls and of the driver's pages; the verdict where a rule decides."""
    rng = random.Random(2)
    parts = ["http", "://", "www.", "example", ".com", ".net", "/", "/en/", "/es/", "/fr/x", "?", "#", "EN", "a", ":80", "com", "net"]
    rows = [(-1 - k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for k in range(600)]
    rows += [(-1000 - k, f"https://{rng.choice(['', 'x.', 'www.'])}{rng.choice(['example.com', 'Net', 'b.net', 'acom'])}{rng.choice(['/en/', '/en', '/fr/?', '/es/#', ''])}q") for k in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    if os.path.isdir("/root/testdata/sf0.001"):
        pages = pages.unionByName(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url"))
    pages.write.parquet(str(tmp_path / "pages"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    got = {r["page_id"]: r for r in urls.judge_urls(spark.read.parquet(str(tmp_path / "pages"))).collect()}
    for page, host, path, rule, what in db.sql(RULES_SQL).fetchall():
        assert (got[page]["host"], got[page]["path"], got[page]["rule"]) == (host, path, rule), page
        assert what is None or got[page]["verdict"] == what


def test_urls(spark):
    pages = spark.createDataFrame([(u[0], u[1], "h", "p") for u in URLS], "page_id long, url string, host string, path string")
    rows = sorted(urls.judge_urls(pages).collect(), key=lambda r: r["page_id"])
    for row, (i, _, host, path, rule, verdict) in zip(rows, URLS, strict=True):
        assert (row["page_id"], row["host"], row["path"], row["rule"]) == (i, host, path, rule)
        assert row["verdict"] == (verdict or row["verdict"]) and row["verdict"] in ("allow", "block")
    assert urls.judge_urls(pages.limit(0)).collect() == []


def test_url_model_on_held_out_names(spark):
    names = [("cheap-tablets", 1), ("casino-royal", 1), ("adult-dating", 1), ("free-bets", 1), ("spam-house", 1),
             ("city-library", 0), ("stone-museum", 0), ("river-history", 0), ("morning-post", 0), ("gardens", 0)]
    pages = spark.createDataFrame(
        [(k, f"https://{n}.example.org/en/{k}", y) for k, (n, y) in enumerate(names)], "page_id long, url string, y int"
    )
    verdict = {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages).collect()}
    right = sum((verdict[k] == "block") == bool(y) for k, (_, y) in enumerate(names))
    assert right >= 9


def test_url_model_without_two_classes(spark):
    pages = spark.createDataFrame([(1, "https://a.org/")], "page_id long, url string")
    one = spark.createDataFrame([("https://b.org/", 1.0)], "url string, label double")
    assert urls.judge_urls(pages, labelled=one).first()["verdict"] == "block"
    assert urls.judge_urls(pages, labelled=one.limit(0)).first()["verdict"] == "allow"


def test_bpe_is_the_tokenizer(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, rng = Tokenizer.from_file(path), random.Random(1)
    alphabet = "ab 'sTé\n\t\x85  　1.!?中à😀\r<|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 70))) for _ in range(2000)]
    texts += [t or "" for _, t in odd_rows()] + ["a <|endoftext|> b<|endoftext|>", "   ", "x  y", "à \xa0 \xa0 b", sentence(rng, 3000)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in bpe.encode(docs, path).collect()}
    digests = {r["doc_id"]: r for r in bpe.digests(docs, path).collect()}
    for k, text in [*enumerate(texts), (-1, "")]:
        ids = plain.encode(text, add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert bytes(rows[k]["ids"]) == raw and rows[k]["n_tokens"] == len(ids)
        decoded = plain.decode(ids, skip_special_tokens=False)
        assert rows[k]["decoded"] == decoded
        assert digests[k]["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert digests[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_memo_overflow(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, rng = bpe.Codec(path), random.Random(2)
    texts = [sentence(rng, 40, [f"word{k}" for k in range(90)]) for _ in range(20)]
    for t in texts:
        assert codec.encode(t) == b"".join(
            i.to_bytes(4, "little") for i in codec.whole.encode(t, add_special_tokens=False).ids
        )


def test_chat_examples(spark):
    hard = "<\\|im_end|> <|im_end|> [INST] [\\INST] <s>\\ <\\\\s>"
    turns = spark.createDataFrame(
        [(1, 0, "user", hard), (1, 1, "assistant", hard), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (1, 4, "user", "d")],
        "conv_id long, turn long, role string, text string",
    ).withColumn("example", F.lit("clash"))
    rows = chat.expand(turns).withColumn("back", chat.read_back(F.col("formatted"))).orderBy("example").collect()
    assert [r["example"] for r in rows] == [1, 3, 4]
    assert [[(t["role"], t["text"]) for t in r["back"]] for r in rows][2] == [
        ("user", hard), ("assistant", hard), ("user", "b"), ("assistant", "c"), ("user", "d")
    ]
    first = rows[0]
    assert first["formatted"][first["loss_start"] :].startswith(first["formatted"][first["loss_start"] :][: first["loss_chars"]] + chat.END)
    assert rows[2]["loss_start"] is None
    assert first["formatted"].count("<|im_end|>") == 2
    assert chat.digests(chat.expand(turns.limit(0))).collect() == []
