"""k nearest neighbours of many query vectors at once.

Work is done in tiles of queries x rows. A task never holds more than its tile and
the current best ``k`` per query, and only those leave the task.

Query sets that fit into every task are broadcast, and the corpus is read where it lies. For larger ones
the corpus is dealt to the cells of sampled pivots. Queries meet the rows of their nearest cells first,
which bounds the distance of their ``k``-th neighbour; by the triangle inequality a cell whose rows are all
farther away than that cannot add anything, and the query is not sent there. Cells are cut into tiles
by a hash of the row id and by their measured sizes, so a hot cell is no hot task.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distance import DEFAULT_METRIC, Steps, all_pairs, check_metric, manhattan, matrix, paired
from ..sources.staging import stage
from .sizing import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, bound_slice, small_row_count

TILE_CELLS = 2_000_000
#: Most rows of a side of a tile, and most bytes of its vectors as doubles.
BLOCK_ROWS = 100_000
BLOCK_BYTES = 128 << 20
#: Rows of the first part of a batch and most rows of a later one, and pairs that wait for a merge.
FIRST_ROWS = 2_000
MAX_ROWS = 32_000
MAX_NEW = 4_000_000
#: Share of the pairs that steps may leave, above which they are given up, and pairs of which the distance is taken at once.
LEFT_SHARE = 0.1
LEFT_PAIRS = 50_000
#: Most queries of a tile.
ASKED_ROWS = 25_000
#: Fewest queries of a tile that is cut smaller so that all cores have some, and tiles for a core.
LEAST_ASKED = 500
CORE_TILES = 4
#: Pivots grow with the square root of the corpus up to this number.
MAX_PIVOTS = 2048
LOG = logging.getLogger(__name__)
RESULT = "query_id long, id long, distance double"

# Tells which rows of a tile a query may see: (query slice, batch) -> bool matrix.
Mask = Callable[[np.ndarray, pa.RecordBatch, np.ndarray], np.ndarray]


class Best:
    """The best ``k`` rows per query among the batches seen so far."""

    def __init__(self, ids, vectors, k, metric, decimals=None, bounds=None):
        self.ids, self.vectors = ids, vectors
        self.k, self.metric, self.decimals = k, metric, decimals
        # matrix products carry noise and rounding makes near values equal, so rows
        # this close to the k-th one are all looked at exactly
        self.margin = 1e-6 if decimals is None else max(1e-6, 2.0 * 10.0**-decimals)
        self.query = np.empty(0, np.int64)
        self.row = np.empty(0, np.int64)
        self.distance = np.empty(0)
        self.bound = np.full(len(ids), np.inf) if bounds is None else bounds.copy()
        self.norm = np.sqrt(np.square(vectors).sum(axis=1)) if len(ids) else np.empty(0)
        self._single, self._steps, self._new = None, None, []

    def _margin(self, numbers, longest, bound):
        """How far the fast distances may be off, per query."""
        if self.metric == "l2":
            scale = self.norm[numbers] + longest
        elif self.metric == "inner_product":
            scale = self.norm[numbers] * longest
        else:
            scale = np.where(np.isfinite(bound), np.abs(bound), 1.0)
        return self.margin * np.maximum(1.0, scale)

    def add(self, row_ids: np.ndarray, rows: np.ndarray, visible=None) -> None:
        """Take in a batch; ``visible(query numbers)`` may hide rows from queries.

        The batch is cut into parts that grow: the first ones bound the ``k``-th distances, and of the later
        ones only rows within these bounds are looked at any further.
        """
        if not len(rows) or not len(self.ids):
            return
        longest = float(np.sqrt(np.square(rows).sum(axis=1).max()))
        size, at, useful = FIRST_ROWS if visible is None else len(rows), 0, None
        while at < len(rows):
            part = slice(at, min(at + size, len(rows)))
            for numbers, near in self._near(rows[part], longest, visible):
                if np.count_nonzero(near) > 8 * self.k * len(numbers) + 1000:
                    if useful is None:
                        useful = first_copies(row_ids, rows, self.k)
                    near &= useful[part][None, :]
                self._take(near, numbers, row_ids[part], rows[part])
            self._merge()
            at, size = part.stop, min(4 * size, MAX_ROWS)

    def _near(self, rows, longest, visible):
        """Per slice of the queries which rows may be among their best."""
        fast = self._fast(rows, longest) if visible is None else None
        known = np.isfinite(self.bound) if fast is not None else np.zeros(len(self.ids), bool)
        step = max(1, TILE_CELLS // len(rows))
        bounded, others = np.flatnonzero(known), np.flatnonzero(~known)
        for start in range(0, len(bounded), step):
            numbers = bounded[start : start + step]
            yield numbers, fast(numbers, self.bound[numbers] + self._margin(numbers, longest, self.bound[numbers]))
        for start in range(0, len(others), step):
            numbers = others[start : start + step]
            found = all_pairs(self.metric, self.vectors[numbers], rows)
            found = np.where(np.isnan(found), np.inf, found)
            hidden = None if visible is None else ~visible(numbers)
            if hidden is not None:
                found[hidden] = np.inf
            kth = min(self.k, len(rows)) - 1
            local = np.partition(found, kth, axis=1)[:, kth]
            if len(rows) < self.k:
                local[:] = np.inf
            bound = np.minimum(self.bound[numbers], local)
            near = found <= (bound + self._margin(numbers, longest, bound))[:, None]
            if hidden is not None:
                near &= ~hidden
            yield numbers, near

    def _fast(self, rows, longest):
        """``(query numbers, limits) -> bool matrix`` of the rows within the limits, in single precision with room for
        its noise; None for vectors that it cannot hold."""
        if self._single is None:
            fits = bool(np.isfinite(self.norm).all()) and float(self.norm.max()) < 1e15
            points = self.vectors
            if self.metric == "cosine":
                points = -points / np.where(self.norm == 0, 1.0, self.norm)[:, None]
            elif self.metric != "manhattan":
                points = (-2.0 if self.metric == "l2" else -1.0) * points
            if self.metric == "l2":
                points = np.column_stack([points, np.ones(len(points))])
            self._single = fits, points.astype(np.float32) if fits else None
        fits, points = self._single
        if not fits or not longest < 1e15:
            return None
        square = np.square(rows).sum(axis=1)
        noise = (rows.shape[1] + 16) * 2.0**-23
        if self.metric == "cosine":
            rows = rows / np.where(square == 0, 1.0, np.sqrt(square))[:, None]
        elif self.metric == "l2":
            rows = np.column_stack([rows, square])
        elif self.metric == "manhattan":
            by_steps = self._within_steps(rows)
        rows = rows.astype(np.float32)

        def within(numbers: np.ndarray, limit: np.ndarray) -> np.ndarray:
            norm = self.norm[numbers]
            if self.metric == "manhattan":
                room = noise * np.sqrt(rows.shape[1]) * (norm + longest)
                near, limit = by_steps(numbers, limit + room), (limit + room).astype(np.float32)
                if near is None:
                    return manhattan(points[numbers], rows) <= limit[:, None]
                query, row = np.divmod(np.flatnonzero(near), near.shape[1])
                for at in range(0, len(query), LEFT_PAIRS):
                    asked, own = query[at : at + LEFT_PAIRS], row[at : at + LEFT_PAIRS]
                    near[asked, own] = paired("manhattan", points[numbers[asked]], rows[own]) <= limit[asked]
                return near
            if self.metric == "l2":
                limit = np.square(np.maximum(limit, 0.0)) - np.square(norm) + noise * np.square(norm + longest)
            elif self.metric == "cosine":
                limit = limit - 1.0 + noise
            else:
                limit = limit + noise * norm * longest
            return points[numbers] @ rows.T <= limit.astype(np.float32)[:, None]

        return within

    def _within_steps(self, rows):
        """``(query numbers, limits) -> bool matrix`` of the rows that may lie within the limits by their steps, which takes
        a third of the time; None once that leaves too many."""
        if self._steps is None:
            steps = Steps(self.vectors)
            self._steps = steps, *steps.cut(self.vectors)
        if not self._steps:
            return lambda numbers, limit: None
        steps, asked, asked_away = self._steps
        own, away = steps.cut(rows)
        across = np.ascontiguousarray(own.T)

        def within(numbers: np.ndarray, limit: np.ndarray) -> np.ndarray | None:
            if not self._steps:
                return None
            near = steps.within(asked[numbers], across, away, limit / steps.size + asked_away[numbers] + 1e-6)
            if np.count_nonzero(near) > LEFT_SHARE * near.size:
                self._steps = ()
                return None
            return near

        return within

    def _take(self, near, numbers, row_ids, rows) -> None:
        """Exact distances of the marked pairs, kept for the next merge if they can count."""
        query, row = np.divmod(np.flatnonzero(near), near.shape[1])
        for at in range(0, len(query), BLOCK_ROWS):
            asked, own = numbers[query[at : at + BLOCK_ROWS]], row[at : at + BLOCK_ROWS]
            distance = paired(self.metric, self.vectors[asked], rows[own])
            if self.decimals is not None:
                distance = np.round(distance, self.decimals)
            keep = ~(distance > self.bound[asked])
            self._new.append((asked[keep], row_ids[own[keep]], distance[keep]))
            if sum(len(q) for q, _, _ in self._new) > MAX_NEW:
                self._merge()

    def _merge(self) -> None:
        if not self._new:
            return
        query, row, distance = (np.concatenate([old, *new]) for old, new in zip(
            (self.query, self.row, self.distance), zip(*self._new)
        ))
        self._new = []
        order = np.lexsort((row, distance, query))
        query, row, distance = query[order], row[order], distance[order]
        starts = np.searchsorted(query, query, side="left")
        keep = np.arange(len(query)) - starts < self.k
        last = np.arange(len(query)) - starts == self.k - 1
        self.query, self.row, self.distance = query[keep], row[keep], distance[keep]
        full = np.where(np.isnan(distance[last]), np.inf, distance[last])
        self.bound[query[last]] = np.minimum(self.bound[query[last]], full)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[self.query]), pa.array(self.row), pa.array(self.distance)],
            names=["query_id", "id", "distance"],
        )


def first_copies(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Marks the ``k`` smallest ids of each vector.

    Further copies tie with these and lose by id, so a vector that fills a third of
    the corpus costs no more than ``k`` rows.
    """
    rows = np.ascontiguousarray(rows)
    packed = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel()
    _, group = np.unique(packed, return_inverse=True)
    order = np.lexsort((ids, group))
    sorted_group = group[order]
    place = np.arange(len(ids)) - np.searchsorted(sorted_group, sorted_group, side="left")
    keep = np.zeros(len(ids), bool)
    keep[order[place < k]] = True
    return keep


def _valid(batch, id_index: int, vector_index: int, dims: int | None):
    """Ids and matrix of the rows that have a vector, and which rows those are."""
    valid = batch.column(vector_index).is_valid()
    part = batch.filter(valid)
    ids = np.asarray(part.column(id_index).cast(pa.int64()))
    vectors = part.column(vector_index)
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return part, ids, matrix(vectors, dims)


def top_k(candidates: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of each query's candidates, with a ``rank`` from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("distance").asc_nulls_last(), "id")
    ranked = candidates.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def bucket_candidates(
    corpus: DataFrame, queries: DataFrame, k: int, metric: str, decimals: int | None,
    block_rows: int | None = None, asked_parts: int = 1,
) -> DataFrame:
    """Best ``k`` per query and tile among the rows that share a bucket with it.

    Both sides have ``id``, ``embedding`` and ``bucket``; a row may stand in several. Buckets
    are cut by a hash of the id into tiles of at most about ``BLOCK_ROWS`` rows and
    ``BLOCK_BYTES`` bytes a side, by their measured sizes, so neither a hot bucket nor many
    queries meet in one task. The queries of a bucket are cut into ``asked_parts`` at least, where they are many. A pair found in several buckets is given once. A ``bound`` of the queries, where
    there is one, is a distance beyond which no row can count.
    """
    def sized(rows: DataFrame, name: str, most: int, parts: int = 1) -> DataFrame:
        count, bytes_ = F.count(F.lit(1)), 8 * F.coalesce(F.sum(F.size("embedding").cast("long")), F.lit(0))
        tiles = F.greatest(F.ceil(count / (block_rows or most)), F.ceil(bytes_ / BLOCK_BYTES), F.lit(1).cast("long"),
                           F.least(F.lit(parts).cast("long"), F.ceil(count / LEAST_ASKED)))
        return rows.groupBy("bucket").agg(tiles.alias(name))

    tiles = sized(corpus, "rows", BLOCK_ROWS).join(sized(queries, "asked", ASKED_ROWS, asked_parts), "bucket")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.col(own)).alias(f"{own}_part")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(f"{other}_part")
        bound = ["bound"] if "bound" in side.columns else []
        placed = side.join(tiles, "bucket").select("id", "embedding", "bucket", *bound, own, other, part)
        return placed.select("id", "embedding", "bucket", *bound, f"{own}_part", every).select(
            F.col("id").cast("long").alias("id"), "embedding", "bucket", *bound,
            F.col("rows_part").cast("long").alias("rows_part"), F.col("asked_part").cast("long").alias("asked_part"),
        )

    keys = ["bucket", "rows_part", "asked_part"]

    def tile(asked: pa.Table, rows: pa.Table) -> pa.Table:
        best = Best(np.empty(0, np.int64), np.empty((0, 0)), k, metric, decimals)
        if len(asked) and len(rows):
            query_ids, row_ids = (np.asarray(t["id"].combine_chunks()) for t in (asked, rows))
            vectors, others = (matrix(t["embedding"].combine_chunks(), None) for t in (asked, rows))
            bounds = None
            if "bound" in asked.column_names:
                bounds = np.asarray(asked["bound"].combine_chunks().fill_null(np.inf), dtype=np.float64)
                bounds = np.where(np.isnan(bounds), np.inf, bounds)
            best = Best(query_ids, vectors, k, metric, decimals, bounds)
            best.add(row_ids, others)
        return pa.Table.from_batches([best.batch()])

    left = dealt(queries.filter(F.col("embedding").isNotNull()), "asked", "rows").groupBy(*keys)
    right = dealt(corpus.filter(F.col("embedding").isNotNull()), "rows", "asked").groupBy(*keys)
    return left.cogroup(right).applyInArrow(tile, RESULT).dropDuplicates(["query_id", "id"])


def local_candidates(
    corpus: DataFrame,
    query_ids: np.ndarray,
    queries: np.ndarray,
    k: int,
    metric: str,
    decimals: int | None,
    mask: Mask | None = None,
    bounds: np.ndarray | None = None,
) -> DataFrame:
    """Best ``k`` of every corpus partition for a bounded set of queries.

    ``corpus`` has ``id``, ``embedding`` and whatever ``mask`` reads. One pass over
    it, no shuffle of it. ``bounds`` are distances beyond which no row can count.
    """
    shared = corpus.sparkSession.sparkContext.broadcast((query_ids, queries, bounds))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, limits = shared.value
        best = Best(ids, vectors, k, metric, decimals, limits)
        for batch in batches if len(ids) else ():
            part, row_ids, rows = _valid(batch, 0, 1, vectors.shape[1])
            if len(row_ids):
                visible = None if mask is None else (lambda n, p=part: mask(n, p))
                best.add(row_ids, rows, visible)
        yield best.batch()

    return corpus.mapInArrow(run, RESULT)


class Pivots:
    """Sampled centers, and the space in which the triangle inequality holds for a metric.

    That is the metric itself for L2 and Manhattan, L2 between unit vectors for cosine, and for the
    inner product L2 after the corpus vectors got one more coordinate that makes them all equally long.
    """

    def __init__(self, metric: str, longest: float, points: np.ndarray):
        self.metric, self.longest = metric, longest
        self.centers = self.lift(points, False)

    def lift(self, vectors: np.ndarray, asked: bool) -> np.ndarray:
        """Vectors of the corpus, or those that are ``asked`` for, in that space."""
        if self.metric == "cosine":
            norm = np.sqrt(np.square(vectors).sum(axis=1, keepdims=True))
            return vectors / np.where(norm == 0, 1.0, norm)
        if self.metric == "inner_product":
            rest = np.zeros(len(vectors)) if asked else np.sqrt(
                np.maximum(self.longest**2 - np.square(vectors).sum(axis=1), 0.0)
            )
            return np.column_stack([vectors, rest])
        return vectors

    def distances(self, vectors: np.ndarray, asked: bool) -> np.ndarray:
        """Of each vector to each pivot."""
        name = "manhattan" if self.metric == "manhattan" else "l2"
        lifted, step = self.lift(vectors, asked), max(1, TILE_CELLS // len(self.centers))
        parts = [all_pairs(name, lifted[at : at + step], self.centers) for at in range(0, len(lifted), step)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.centers)))

    def reach(self, vectors: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """A distance of the metric from each query as one of that space, with room for noise."""
        if self.metric == "cosine":
            far = np.sqrt(2.0 * np.maximum(distance, 0.0))
        elif self.metric == "inner_product":
            far = np.sqrt(np.maximum(np.square(vectors).sum(axis=1) + self.longest**2 + 2.0 * distance, 0.0))
        else:
            far = distance
        return far * (1 + 1e-6) + 1e-6 * (1 + self.longest)


def _placed(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """Corpus rows with their ``bucket``, the nearest pivot, and how ``far`` it is."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    @F.arrow_udf("struct<bucket: int, far: double>")
    def place(batch: pa.Array) -> pa.Array:
        found = shared.value.distances(matrix(batch, None), False)
        near = found.argmin(axis=1) if len(found) else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(near.astype(np.int32)), pa.array(found[np.arange(len(near)), near])], names=["bucket", "far"]
        )

    return rows.withColumn("_at", place(F.col("embedding"))).select("id", "embedding", "_at.bucket", "_at.far")


def pivot_candidates(
    corpus: DataFrame, queries: DataFrame, k: int, metric: str, decimals: int | None,
    block_rows: int | None = None, seed: int = 11,
) -> DataFrame:
    """Best rows of query sets too large to hand to every task, cell by cell."""
    present, asked = (df.filter(F.col("embedding").isNotNull()) for df in (corpus, queries))
    square = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    zero = (square == 0) if metric == "cosine" else F.lit(False)
    size = present.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(zero.cast("long")), F.lit(0)).alias("zeros"),
        F.sqrt(F.coalesce(F.max(square), F.lit(0.0))).alias("longest"),
    ).first()
    useful = size["rows"] - size["zeros"]

    def by_id(rows: DataFrame, of: DataFrame, count: int) -> DataFrame:
        """The first ``count`` rows by id, at no known distance, for each of the queries."""
        ids = [r[0] for r in of.select(F.col("id").cast("long")).orderBy("id").limit(count).collect()]
        every = F.explode(F.array(*[F.lit(i) for i in ids]).cast("array<long>")).alias("id")
        return rows.select(F.col("id").cast("long").alias("query_id"), every, F.lit(float("nan")).alias("distance"))

    # a zero vector has no direction: from it nothing, and for others it, is at a known distance
    aside = by_id(asked.filter(zero), present, k)
    if useful < k and size["zeros"]:
        aside = aside.unionByName(by_id(asked.filter(~zero), present.filter(zero), k - useful))
    if not useful:
        return aside
    count = min(MAX_PIVOTS, max(1, round(useful**0.5)))
    rows = present.filter(~zero)
    sample = rows.select("embedding").sample(fraction=min(1.0, 1.5 * count / useful), seed=seed).limit(count)
    points = sample.toArrow()["embedding"].combine_chunks()
    if not len(points):
        points = rows.select("embedding").limit(1).toArrow()["embedding"].combine_chunks()
    if isinstance(points, pa.ChunkedArray):
        points = points.combine_chunks()
    pivots = Pivots(metric, float(size["longest"]) if metric != "cosine" else 1.0, np.unique(matrix(points, None), axis=0))
    cells = stage(_placed(rows, pivots), "knn-cells")
    stats = cells.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("far").alias("least"), F.max("far").alias("most")
    ).toArrow()  # one row per pivot
    held, least, most = (np.zeros(len(pivots.centers)) for _ in range(3))
    at = stats["bucket"].to_numpy()
    for name, values in (("n", held), ("least", least), ("most", most)):
        values[at] = stats[name].to_numpy()
    dims = max(1, pivots.centers.shape[1])
    group = _cell_groups(pivots.centers, held, min(block_rows or BLOCK_ROWS, max(1, BLOCK_BYTES // (8 * dims))))
    shared = corpus.sparkSession.sparkContext.broadcast((pivots, held, least, most, group))
    slack = 0.0 if decimals is None else 10.0**-decimals

    @F.arrow_udf("array<int>")
    def first(batch: pa.Array) -> pa.Array:
        """The nearest cells that hold ``k`` rows together."""
        pivots, held = shared.value[:2]
        vectors = matrix(batch, None)
        order = np.argsort(np.where(held > 0, pivots.distances(vectors, True), np.inf), axis=1, kind="stable")
        enough = 1 + (np.cumsum(held[order], axis=1) < k).sum(axis=1)
        return _number_lists([o[: min(n, (held > 0).sum())] for o, n in zip(order, enough)])

    @F.arrow_udf("array<int>")
    def others(batch: pa.Array, seen: pa.Array, bound: pa.Array) -> pa.Array:
        """Groups of further cells that may hold a row within the bound, which a missing one does not limit."""
        pivots, held, least, most, group = shared.value
        vectors = matrix(batch, None)
        far = pivots.distances(vectors, True)
        limit = np.asarray(bound.fill_null(np.inf))
        limit = np.where(np.isfinite(limit), pivots.reach(vectors, np.where(np.isfinite(limit), limit + slack, 0.0)), np.inf)
        open_ = (held > 0) & (np.maximum(far - most, least - far) <= limit[:, None])
        for n, own in enumerate(seen.to_pylist()):
            open_[n, own] = False
        return _number_lists([np.unique(group[o]) for o in open_])

    @F.arrow_udf("int")
    def grouped(cell: pa.Array) -> pa.Array:
        return pa.array(shared.value[4][np.asarray(cell)].astype(np.int32))

    mine = stage(asked.filter(~zero).select(
        F.col("id").cast("long").alias("id"), "embedding", first(F.col("embedding")).alias("seen")
    ), "knn-queries")
    start = mine.select("id", "embedding", F.explode("seen").alias("bucket"))
    found = stage(top_k(bucket_candidates(cells, start, k, metric, decimals, block_rows), k), "knn-first")
    bounds = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("distance").alias("bound"))
    further = stage(mine.join(bounds, "id", "left").select(
        "id", "embedding", "bound", F.explode(others(F.col("embedding"), F.col("seen"), F.col("bound"))).alias("bucket")
    ), "knn-further")
    if LOG.isEnabledFor(logging.INFO):
        done, rows_of = 0.0, np.bincount(group, held)
        for asked_for, sizes in ((start, held), (further, rows_of)):
            pairs = asked_for.groupBy("bucket").count().toArrow()
            done += float((sizes[pairs["bucket"].to_numpy()] * pairs["count"].to_numpy()).sum())
        LOG.info("compares %.0f of %.0f pairs", done, useful * mine.count())
    groups = cells.select("id", "embedding", grouped(F.col("bucket")).alias("bucket"))
    wanted = CORE_TILES * cells.sparkSession.sparkContext.defaultParallelism
    parts = -(-wanted // max(1, len(np.unique(group))))
    more = bucket_candidates(groups, further, k, metric, decimals, block_rows, parts)
    # a group may hold cells that were seen before
    return found.drop("rank").unionByName(more).dropDuplicates(["query_id", "id"]).unionByName(aside)


def _cell_groups(centers: np.ndarray, held: np.ndarray, rows: int) -> np.ndarray:
    """The group of each cell: cells side by side along the widest direction, about ``rows`` rows a group. A query
    goes to a group once, however many of its cells it needs, so it is copied at most once per group."""
    spread = centers - centers.mean(axis=0)
    along = spread @ np.linalg.svd(spread, full_matrices=False)[2][0]
    order = np.argsort(along, kind="stable")
    group = np.zeros(len(centers), np.int64)
    group[order] = (np.cumsum(held[order]) - held[order]) // rows
    return np.unique(group, return_inverse=True)[1]


def _number_lists(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in lists]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *(x.astype(np.int32) for x in lists)])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def collect_vectors(queries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a query table whose size was checked before."""
    rows = queries.filter(F.col("embedding").isNotNull()).toArrow().combine_chunks()
    if not rows.num_rows:
        return np.empty(0, np.int64), np.empty((0, 0))
    _, ids, vectors = _valid(rows, 0, 1, None)
    return ids, vectors


def first_bounds(
    corpus: DataFrame, ids: np.ndarray, vectors: np.ndarray, k: int, metric: str,
    decimals: int | None, every: int,
) -> np.ndarray:
    """Distance of each query's ``k``-th neighbour among one in ``every`` corpus rows.

    The whole corpus can only do better, so this is a bound on the final result.
    """
    few = corpus.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0)
    found = top_k(local_candidates(few, ids, vectors, k, metric, decimals), k)
    kth = found.filter(F.col("rank") == k).select("query_id", "distance").toPandas()
    bounds = np.full(len(ids), np.inf)
    order = np.argsort(ids)
    place = order[np.searchsorted(ids, kth["query_id"].to_numpy(), sorter=order)]
    bounds[place] = np.where(kth["distance"].isna(), np.inf, kth["distance"])
    return bounds


def knn_join(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = DEFAULT_METRIC,
    query_id: str = "id",
    id_col: str = "id",
    embedding: str = "embedding",
    decimals: int | None = None,
    max_query_rows: int = MAX_BROADCAST_ROWS,
    max_query_bytes: int = MAX_BROADCAST_BYTES,
    block_rows: int | None = None,
    first_slice: int | None = None,
) -> DataFrame:
    """Exact ``k`` nearest corpus rows of every query: ``(query_id, id, distance, rank)``.

    Ids are integers and unique. Queries within the size bounds are broadcast and the
    corpus is read where it lies; larger query sets go through the cells of pivots. On a
    large corpus one in ``first_slice`` rows is searched first, and its result keeps
    the tasks from handing on rows that cannot count. With ``decimals`` distances are
    rounded before ranking, ties go to the smaller id.
    """
    check_metric(metric)
    left = queries.select(F.col(query_id).alias("id"), F.col(embedding).alias("embedding"))
    right = corpus.select(F.col(id_col).alias("id"), F.col(embedding).alias("embedding"))
    if small_row_count(left, max_query_rows, max_query_bytes) is None:
        found = pivot_candidates(right, left, k, metric, decimals, block_rows)
    else:
        ids, vectors = collect_vectors(left)
        every = first_slice or bound_slice(corpus)
        bounds = first_bounds(right, ids, vectors, k, metric, decimals, every) if every else None
        found = local_candidates(right, ids, vectors, k, metric, decimals, None, bounds)
    return top_k(found, k)
