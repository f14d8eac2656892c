"""Ranked lexical search of many queries at once, with shared parts of their sums computed once.

A query's score for a document is a sum over its terms, and what a term adds depends on term and
document alone. Queries that share terms share parts of their sums.

How it is made:

1. The queries are cut into blocks of about ``BLOCK_TERMS`` terms, by hash; the number of blocks is
   measured. Each block is answered over all documents; only a block's terms are ever on the driver.
2. Mining: each query is a list of terms, commonest (among the queries) first and terms of the same
   queries side by side. Neighbours that two or more queries have become one node that adds the two; this
   goes on with the nodes, until no queries share a pair. The nodes are the DAG; every query
   is left with a few nodes to add.
3. One pass over the texts writes each document's number of terms and its counts of the block's terms (its
   accumulators' input); the corpus figures and document frequencies come from that table.
4. In tasks over that table the DAG is evaluated for some hundred documents at a time, level by level:
   each shared node is one accumulator per document, computed once and added into all
   queries that use it. A task hands on its best ``k`` per query; they are ranked within slices of the ids,
   then per query.

Nothing is joined or exchanged by term, so common terms make no hot key, and a task holds ``DOCS`` documents
and the block's nodes at a time. All arithmetic on scores is in 64-bit integers.

Terms are compared by 64-bit hashes.

Defined results: null and empty texts have no terms: such documents are not counted or found, such
queries find nothing. Rows of queries with the same id and text are one query; one id with several texts is
several, each with ranks of its own. Document rows are ranked one by one, equal ones with different ranks;
a null id comes after all others among equal scores. Ids of documents are whole numbers; others
raise an error. Without documents or queries there are no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import SYMBOL_CLASS, lower_ascii, split_words, whole
from .words import U64, mix, runs

K = 10
BLOCK_TERMS = 100_000
#: Documents whose accumulators are held at a time, and candidates before they are cut to the best.
DOCS = 256
CANDIDATES = 1 << 18
SLICES = 64
#: Bytes of text whose words a task holds at a time.
RUN = 1 << 20


def share(queries: list[list[int]], leaves: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Pairs to add, the first making node ``leaves``, the next ``leaves + 1`` and so on, and for each
    query the nodes that are left to add. ``queries`` are lists of different leaves."""
    pairs, numbers = [], {}
    while True:
        users = defaultdict(list)
        for q, nodes in enumerate(queries):
            for node in nodes:
                users[node].append(q)
        rank = {node: (-len(qs), hash(tuple(qs)), node) for node, qs in users.items()}
        queries = [sorted(nodes, key=rank.__getitem__) for nodes in queries]
        counts = Counter(pair for nodes in queries for pair in zip(nodes, nodes[1:]))
        common = {pair: count for pair, count in counts.items() if count > 1}
        if not common:
            return pairs, queries
        for q, nodes in enumerate(queries):
            free, taken = [True] * len(nodes), {}
            places = [i for i in range(len(nodes) - 1) if (nodes[i], nodes[i + 1]) in common]
            for i in sorted(places, key=lambda i: (-common[nodes[i], nodes[i + 1]], i)):
                if free[i] and free[i + 1]:
                    free[i] = free[i + 1] = False
                    taken[i] = nodes[i], nodes[i + 1]
            left = [n for n, f in zip(nodes, free, strict=True) if f]
            for _, pair in sorted(taken.items()):
                if pair not in numbers:
                    numbers[pair] = leaves + len(pairs)
                    pairs.append(pair)
                left.append(numbers[pair])
            queries[q] = left


class Block:
    """Queries of one block: ``keys`` are theirs, ``terms`` the hashes of their terms in order; leaves are
    (term, times it stands in a query)."""

    def __init__(self, keys: list[int], terms: list[str], uses: list[tuple[int, str, int]]):
        hashes = np.concatenate([np.zeros(0, U64), *(r.hashes for r in runs(pa.array(terms, pa.string()), "symbol"))])
        order = np.argsort(hashes)
        self.keys, self.terms = np.array(keys, np.int64), hashes[order]
        code = {terms[t]: c for c, t in enumerate(order.tolist())}
        number = {key: q for q, key in enumerate(keys)}
        leaf: dict[tuple[int, int], int] = {}
        queries = [[] for _ in keys]
        for key, term, times in uses:
            queries[number[key]].append(leaf.setdefault((code[term], times), len(leaf)))
        self.leaf_term, self.leaf_times = np.array(list(leaf), np.int64).reshape(-1, 2).T
        pairs, rest = share(queries, len(leaf))
        level = [0] * len(leaf)
        for a, b in pairs:
            level.append(1 + max(level[a], level[b]))
        self.nodes = len(level)
        made, pairs = np.array(level[len(leaf) :], np.int64), np.array(pairs, np.int64).reshape(-1, 2)
        self.levels = [(len(leaf) + np.flatnonzero(made == n), *pairs[made == n].T) for n in range(1, 1 + max(level, default=0))]
        used = [q for q, nodes in enumerate(rest) if nodes]
        self.used = np.array(used, np.int64)
        self.rest = np.array([node for q in used for node in rest[q]], np.int64)
        self.first = np.cumsum([0] + [len(rest[q]) for q in used[:-1]]) if used else np.zeros(0, np.int64)

    def sums(self, leaves: np.ndarray) -> np.ndarray:
        """Sums of all queries of the block (those with terms), from values of the leaves by document."""
        acc = np.empty((self.nodes, leaves.shape[1]), np.int64)
        acc[: len(leaves)] = leaves
        for out, a, b in self.levels:
            acc[out] = acc[a] + acc[b]
        return np.add.reduceat(acc[self.rest], self.first)


def _profiles(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """From (doc, text): (doc, n, codes, counts) of documents that have terms."""
    terms = shared.value
    bits = np.zeros(1 << 20, bool)
    bits[(mix(terms, 3) >> U64(44)).astype(np.int64)] = True
    for batch in batches:
        for run in runs(batch.column(1), "symbol", size=RUN):
            n = np.diff(run.first)
            at = np.flatnonzero(bits[(mix(run.hashes, 3) >> U64(44)).astype(np.int64)])
            code = np.searchsorted(terms, run.hashes[at])
            hit = terms[np.minimum(code, len(terms) - 1)] == run.hashes[at] if len(terms) else np.zeros(0, bool)
            text = np.repeat(np.arange(len(run)), n)[at[hit]]
            both, counts = np.unique(text * max(len(terms), 1) + code[hit], return_counts=True)
            text, code = np.divmod(both, max(len(terms), 1))
            some = np.flatnonzero(n)
            first = np.searchsorted(text, np.append(some, len(run))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(run.row + some)), pa.array(n[some]),
                 pa.ListArray.from_arrays(pa.array(first), pa.array(code.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(first), pa.array(counts.astype(np.int32)))],
                names=["doc", "n", "codes", "counts"],
            )


class _Best:
    """The best ``k`` documents per query of what was offered."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.ones(queries, np.int64)
        self.parts, self.size = [], 0

    def offer(self, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        query, doc = np.nonzero(scores >= self.least[:, None])
        self.parts.append((query, scores[query, doc], docs[doc], null[doc]))
        self.size += len(query)
        if self.size > CANDIDATES:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        query, score, doc, null = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((doc, null, -score, query))
        ranked = query[order]
        place = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
        keep, last = order[place < self.k], order[place == self.k - 1]
        self.parts, self.size = [(query[keep], score[keep], doc[keep], null[keep])], len(keep)
        self.least[query[last]] = score[last]
        return self.parts[0]


def _scored(batches: Iterator[pa.RecordBatch], shared, k: int) -> Iterator[pa.RecordBatch]:
    """From (doc, n, codes, counts): (query, doc, score), the best of a task."""
    block, weight, total, length = shared.value
    best = _Best(len(block.used), k)
    for batch in batches:
        first = batch.column(2).offsets.to_numpy()
        codes, counts = (batch.column(c).values.to_numpy().astype(np.int64) for c in (2, 3))
        words = batch.column(1).to_numpy()
        docs = batch.column(0).fill_null(0).to_numpy()
        null = ~batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        for lo in range(0, batch.num_rows, DOCS):
            hi = min(lo + DOCS, batch.num_rows)
            at = slice(first[lo], first[hi])
            doc = np.repeat(np.arange(hi - lo), np.diff(first[lo : hi + 1]))
            m = 25 + 75 * words[lo:hi] * total // length
            tf = counts[at]
            terms = np.zeros((len(weight), hi - lo), np.int64)
            terms[codes[at], doc] = weight[codes[at]] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            best.offer(block.sums(terms[block.leaf_term] * block.leaf_times[:, None]), docs[lo:hi], null[lo:hi])
    if best.parts:
        query, score, doc, null = best.cut()
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.keys[block.used[query]]), pa.array(doc, mask=null), pa.array(score)], names=["query", "doc", "score"]
        )


def _block(uses: DataFrame) -> Block:
    rows = uses.toArrow().sort_by([("query", "ascending"), ("term", "ascending")]).to_pylist()
    terms = sorted({r["term"] for r in rows})
    return Block(sorted({r["query"] for r in rows}), terms, [(r["query"], r["term"], r["times"]) for r in rows])


def _answers(docs: DataFrame, uses: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """(query, doc, score): the best of all tasks, for the queries of one block."""
    block = _block(uses)
    context = docs.sparkSession.sparkContext
    terms = context.broadcast(block.terms)
    profiles = scratch.put(
        docs.mapInArrow(lambda b: _profiles(b, terms), "doc long, n long, codes array<int>, counts array<int>"), "profiles"
    )
    corpus = profiles.agg(F.count("*").alias("total"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    found = profiles.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df")).toArrow()
    weight = np.zeros(len(block.terms), np.int64)
    df = found["df"].to_numpy()
    weight[found["code"].to_numpy()] = np.floor(1000 * np.log((2 * corpus["total"] + 2) / (2 * df + 1))).astype(np.int64)
    shared = context.broadcast((block, weight, corpus["total"], max(corpus["length"], 1)))
    best = scratch.put(profiles.mapInArrow(lambda b: _scored(b, shared, k), "query long, doc long, score long"), "best")
    scratch.drop(profiles)
    return best


def search(
    docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
    query_id: str = "item_id", query_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(query id, rank, document id, score): each query's ``k`` best documents with a score above 0."""
    scratch = Scratch(docs.sparkSession, "lexical")
    asked = queries.select(F.col(query_id).alias("qid"), whole(F.col(query_text)).alias("text")).select(
        "qid", "text", F.xxhash64("qid", "text").alias("query")
    )
    uses = scratch.put(
        asked.dropDuplicates(["query"]).select("query", F.explode(split_words(lower_ascii(F.col("text")), SYMBOL_CLASS)).alias("term"))
        .groupBy("query", "term").agg(F.count("*").alias("times")), "uses",
    )
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    blocks = -(-uses.count() // block_terms)
    answers = [_answers(rows, uses.filter(F.pmod("query", F.lit(blocks)) == b), k, scratch) for b in range(blocks)]
    if not answers:
        answers = [docs.sparkSession.createDataFrame([], "query long, doc long, score long")]
    best = answers[0]
    for more in answers[1:]:
        best = best.unionByName(more)
    order = (F.col("score").desc(), F.col("doc").asc_nulls_last())
    slice_ = F.pmod(F.xxhash64("doc"), F.lit(SLICES))
    best = best.withColumn("slice", slice_).withColumn("rank", F.row_number().over(Window.partitionBy("query", "slice").orderBy(*order)))
    best = best.filter(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    names = asked.select("query", "qid").dropDuplicates(["query"])
    return best.filter(F.col("rank") <= k).join(names, "query").select(
        F.col("qid").alias(query_id), "rank", F.col("doc").alias(id_col), "score"
    )
