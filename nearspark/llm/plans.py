"""Queries of this subpackage over the driver tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import scan_table
from . import bpe, chat, decontaminate, fim, jaccard, lexical, licenses, pst, quality, repeats, sharding, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_SPACE = r"[^\x20\x09-\x0D]+"
_SYMBOL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _licenses_sql() -> str:
    phrases = " UNION ALL ".join(
        f"SELECT {_sql_list(p.split())} AS words, '{label}' AS label" for p, label in licenses.PHRASES
    )
    templates = " UNION ALL ".join(
        f"SELECT {i} AS t, '{label}' AS label, {_sql_list(ws)} AS words, {licenses.needed(len(ws), licenses.THRESHOLD)} AS need, "
        f"{_sql_list(own)}::VARCHAR[] AS marks, {licenses.needed(len(own), licenses.THRESHOLD) if own else 0} AS own"
        for i, ((label, ws), own) in enumerate(zip(licenses.template_sets(), licenses.marks(), strict=True))
    )
    half, block = licenses.BLOCK // 2, licenses.BLOCK
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SYMBOL}') AS w FROM documents),
p AS ({phrases}), t AS ({templates}),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS ls
  FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM d) AS x, p
  WHERE list_slice(w, i + 1, i + len(words)) = words
  GROUP BY doc_id),
blocks AS (
  SELECT doc_id, list_slice(w, b * {half} + 1, b * {half} + {block}) AS c
  FROM (SELECT doc_id, w, unnest(range(0, 1 + greatest(ceil((len(w) - {block}) / {half}.0), 0)::BIGINT)) AS b FROM d)),
met AS (
  SELECT doc_id, list(DISTINCT label) AS ls, max(len(list_intersect(c, words)) / len(words)::DOUBLE) AS s
  FROM blocks, t WHERE len(list_intersect(c, words)) >= need AND len(list_intersect(c, marks)) >= own GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(base.ls, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(met.ls, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(s, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN met USING (doc_id)"""


@query("op1_ngram_jaccard", rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE}') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM g AS a JOIN g AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= {jaccard.PERCENT} * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(y) AS component_id
FROM reach JOIN documents ON doc_id = x LEFT JOIN n USING (doc_id) GROUP BY doc_id""")
def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_components(scan_table(spark, folder, "documents"))


@query("op2_license_scan", _licenses_sql())
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(scan_table(spark, folder, "documents")).drop("blocks")


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(scan_table(spark, folder, "pages"))


@query("op4_suffix_tree")
def op4_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return pst.score(scan_table(spark, folder, "documents"))


TOKENIZER = "byte_bpe_50k.json"


@query("op5_bpe")
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(scan_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


_ESC = r"'([<\[])(\\*)(\|im_start\|>|\|im_sep\|>|\|im_end\|>|/?s>|/?INST\])', '\1\\\2\3', 'g'"
_MARKS = len(chat.START) + len(chat.SEP) + len(chat.END)
_PROBE = "</s>[INST] ok [/INST]"


@query("op6_chat_format", rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{_PROBE}'),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n,
    sum(length(regexp_replace(role, {_ESC})) + length(regexp_replace(text, {_ESC})) + {_MARKS})
      OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant' OR i = n) AS n_examples
FROM n GROUP BY conv_id""")
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_PROBE).alias("text"),
    )
    return chat.digests(chat.expand(rows.unionByName(probe)))


def page_records(pages: DataFrame) -> DataFrame:
    """Crawl records made of the pages: every page is a full response of its site's section
    (host and language, so that a section has many captures), and some time later the
    section is asked again with a validator: the page's ETag, its date, or an unknown tag."""
    text = F.coalesce("html", F.lit(""))
    tag = F.concat(F.lit('"'), F.substring(F.sha2(text, 256), 1, 16), F.lit('"'))
    day = F.concat(F.lit("day "), F.col("page_id"))
    base = pages.select(
        "page_id", F.regexp_replace("url", "[0-9]+.*$", "").alias("url"), tag.alias("tag"), day.alias("day"),
        F.sha2(text, 256).alias("digest"),
    )
    full = base.select(
        (2 * F.col("page_id")).alias("record_id"), F.lit("response").alias("type"), "url", F.col("page_id").alias("time"),
        F.create_map(
            F.lit("etag"), "tag", F.lit("last-modified"), "day", F.lit("content-type"), F.lit("text/html"),
            F.lit("date"), "day",
        ).alias("headers"), F.col("digest").alias("body_digest"),
    )
    later = F.col("page_id") + 1 + F.col("page_id") % 5
    kind = F.col("page_id") % 3
    revisit = base.select(
        (2 * F.col("page_id") + 1).alias("record_id"), F.lit("revisit").alias("type"),
        F.concat(F.col("url"), F.lit("?ref=again#top")).alias("url"), later.alias("time"),
        F.map_filter(F.create_map(
            F.lit("etag"), F.when(kind == 0, F.col("tag")).when(kind == 2, F.lit('"unknown"')),
            F.lit("last-modified"), F.when(kind == 1, F.col("day")),
            F.lit("content-type"), F.lit("not permitted"),
            F.lit("date"), F.concat(F.lit("day "), later),
            F.lit("expires"), F.concat(F.lit("day "), later + 9),
        ), lambda k, v: v.isNotNull()).alias("headers"), F.lit(None).cast("string").alias("body_digest"),
    )
    return full.unionByName(revisit)


@query("op7_warc_revisits", r"""
WITH p AS (
  SELECT page_id, regexp_replace(url, '[0-9]+.*$', '') AS url, sha256(coalesce(html, '')) AS digest FROM pages),
q AS (
  SELECT page_id, digest, '"' || substr(digest, 1, 16) || '"' AS tag, page_id + 1 + page_id % 5 AS later,
    'https://' || regexp_replace(lower(regexp_extract(r, '^[^/?]*')), ':(80|443)$', '')
      || regexp_replace(regexp_extract(r, '^[^/?]*([^?]*)', 1), '(\.html)?/?$', '') AS url
  FROM (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '(?i)^https?://(www\.)?', '') AS r FROM p)),
a AS (
  SELECT v.*, f.page_id AS of_page, f.tag AS old_tag, f.digest AS old_digest
  FROM q AS v ASOF LEFT JOIN q AS f ON v.url = f.url AND v.later > f.page_id),
s AS (
  SELECT *, CASE WHEN page_id % 3 = 0 THEN tag = old_tag WHEN page_id % 3 = 1 THEN page_id = of_page ELSE false END AS ok FROM a)
SELECT 2 * page_id + 1 AS record_id, url AS canonical_url, later AS time, 2 * of_page AS refers_to,
  CASE WHEN url IS NULL THEN 'no_url' WHEN of_page IS NULL THEN 'no_earlier' WHEN ok THEN 'resolved' ELSE 'changed' END AS status,
  CASE WHEN ok THEN old_digest END AS body_digest,
  CASE WHEN ok THEN 'content-type=text/html;date=day ' || later || ';etag=' || old_tag || ';expires=day ' || (later + 9)
    || ';last-modified=day ' || of_page END AS headers
FROM s""")
def op7_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve(page_records(scan_table(spark, folder, "pages")), span=1000)
    pairs = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(pairs, ";"))


@query("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(scan_table(spark, folder, "documents"), scan_table(spark, folder, "benchmark"))


def _quality_sql() -> str:
    ratio = {
        "mean_word_chars": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "word_chars"),
        "stop_ratio": ("n_stop", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "repeat_ratio": ("n_repeat_words", "n_words"),
    }
    tests = []
    for r in quality.RULES:
        part, total = ratio[r.measure]
        value = f"(CASE WHEN {total} > 0 THEN {part}::DOUBLE / {total} ELSE 0 END)"
        inside = " AND ".join(
            [f"{value} >= {r.low}"] * (r.low is not None) + [f"{value} <= {r.high}"] * (r.high is not None)
        )
        tests.append(f"(n_words < {r.from_words} OR ({inside}))")
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_SPACE}')) AS l
  FROM documents),
tri AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri), range(0, 3) AS r(k)
  WHERE c > 1 GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: list_contains({_sql_list(quality.STOP_WORDS)}, lower(x)))) AS n_stop
  FROM d LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(tests)} AS kept
FROM j"""


@query("op9_quality_rules", _quality_sql())
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(scan_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op10_shards")
def op10_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assign(scan_table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op11_substring_dedup", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (
  SELECT doc_id, i, w[i] AS word,
    CASE WHEN i + {repeats.SIZE - 1} <= len(w) THEN sha256(array_to_string(list_slice(w, i, i + {repeats.SIZE - 1}), ' ')) END AS g
  FROM p),
l AS (SELECT g, min(doc_id) AS least FROM g WHERE g IS NOT NULL GROUP BY g),
c AS (
  SELECT doc_id, i, word, coalesce(max(CASE WHEN least < doc_id THEN i END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN {repeats.SIZE - 1} PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM g LEFT JOIN l USING (g)),
k AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM c GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""")
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(scan_table(spark, folder, "documents"), texts=False)


@query("op12_lexical_search", rf"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_SYMBOL}')) AS term FROM documents),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*)::BIGINT AS total, sum(n)::BIGINT AS length FROM n),
f AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM t GROUP BY doc_id, term),
w AS (
  SELECT term, floor(1000 * ln((2 * total + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM f, c GROUP BY term, total),
i AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_SYMBOL}')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*)::BIGINT AS times FROM i GROUP BY item_id, term),
s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * total) // length))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN n USING (doc_id), c GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {lexical.K}""")
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(scan_table(spark, folder, "documents"), scan_table(spark, folder, "benchmark"))


_DRAW = "('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), {at}, 8))::BIGINT"
_P, _S, _M = (fim.MARK[part] for part in ("prefix", "suffix", "middle"))


@query("op13_fill_in_middle", f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    {", ".join(f"{_DRAW.format(at=1 + 8 * k)} AS h{k + 1}" for k in range(4))}
  FROM documents),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '{_P}') OR contains(t, '{_S}') OR contains(t, '{_M}') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN t
      WHEN 'psm' THEN '{_P}' || substr(t, 1, a) || '{_S}' || substr(t, b + 1) || '{_M}' || substr(t, a + 1, b - a)
      ELSE '{_S}' || substr(t, b + 1) || '{_P}' || substr(t, 1, a) || '{_M}' || substr(t, a + 1, b - a) END AS output
  FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(output) AS output_sha256, sha256(t) AS restored_sha256
FROM o""")
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digests(scan_table(spark, folder, "documents"))
