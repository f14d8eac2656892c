"""Approximate search on very large tables, always with an exact re-rank.

``IvfIndex`` cuts the corpus into the cells of a k-means model, ``LshIndex``, which takes the role of
the graph indexes, into the buckets of random hyperplanes. Both store the corpus by bucket, so a search
reads only the buckets it probes: the folders by partition filters, what lies inside them by the
statistics of the files, which are sorted.

How far a search looks by default is measured when an index is built: a bounded sample of rows is
searched exactly, and enough buckets are probed to find ``TARGET`` of these neighbours. In a sample
neighbours are farther away than in the whole corpus, so the figure errs on the side of recall. A search that
finds fewer than ``k`` rows looks further until it has them or has seen all rows; in a batch
only the queries that lack rows go on.

An index is a folder: ``rows`` and a small ``model``. ``load`` opens one again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.distance import DEFAULT_METRIC, all_pairs, check_metric, matrix
from ..sources.staging import new_path, stage
from .knn import TILE_CELLS, bucket_candidates, top_k
from .predicates import bloom_options, metadata_filter, shred_metadata
from .search import DEFAULT_K, similarity_search
from .sizing import has_rows

INDEX_TYPES = ("hnsw", "ivfflat", "diskann")
#: Rows of the sample that decides how far searches look, how many of them are used as queries, and
#: the share of their ``DEFAULT_K`` nearest rows that has to be found.
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 200
TARGET = 0.95
#: Cells grow with the square root of the rows up to this number; above ``DIRECT_LISTS`` of them there
#: are two levels. A cell is trained from about so many rows.
MAX_LISTS = 65_536
DIRECT_LISTS = 256
ROWS_PER_LIST = 128
#: Bits of a bucket's code, which bounds the directory of buckets, and those that name its folder.
BITS = 18
FOLDER_BITS = 6
#: So many codes are written into a filter, more of them are joined.
MAX_LITERALS = 400


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.square(vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norm == 0, 1.0, norm)


def _points(metric: str, vectors: np.ndarray) -> np.ndarray:
    return _unit(vectors) if metric == "cosine" else vectors


def nearest_cells(
    centers: np.ndarray, metric: str, vectors: np.ndarray, count: int | None = None
) -> np.ndarray:
    """The ``count`` nearest centers of each vector (all by default), nearest first."""
    points, found = _points(metric, vectors), []
    step = max(1, TILE_CELLS // len(centers))
    for at in range(0, max(1, len(points)), step):
        gaps = np.square(centers).sum(axis=1)[None, :] - 2 * points[at : at + step] @ centers.T
        if count == 1:
            found.append(gaps.argmin(axis=1)[:, None])
        else:
            found.append(np.argsort(gaps, axis=1, kind="stable")[:, :count])
    return np.concatenate(found)


def _lists(found: np.ndarray) -> pa.Array:
    """A matrix of numbers as a list column."""
    offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))


class Cells:
    """Centers of one level, or of two: ``parents`` then says which of the coarse centers ``tops``
    each belongs to, and a vector goes to a cell of its nearest coarse center."""

    def __init__(self, centers: np.ndarray, parents: np.ndarray, tops: np.ndarray, metric: str):
        self.centers, self.parents, self.tops, self.metric = centers, parents, tops, metric

    def nearest(self, vectors: np.ndarray, count: int | None = None) -> np.ndarray:
        return nearest_cells(self.centers, self.metric, vectors, count)

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.tops):
            return self.nearest(vectors, 1)[:, 0]
        top = nearest_cells(self.tops, self.metric, vectors, 1)[:, 0]
        own = np.zeros(len(vectors), np.int64)
        for parent in np.unique(top):
            rows, cells = np.flatnonzero(top == parent), np.flatnonzero(self.parents == parent)
            own[rows] = cells[nearest_cells(self.centers[cells], self.metric, vectors[rows], 1)[:, 0]]
        return own


def _sample(vectors: DataFrame, rows: int, total: int, seed: int) -> np.ndarray:
    """At most ``rows`` of the vectors in the column ``vector``, as a matrix."""
    few = vectors.sample(fraction=min(1.0, 1.2 * rows / total), seed=seed) if total > rows else vectors
    found = few.limit(rows).toArrow().combine_chunks()["vector"]
    return matrix(found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found, None)


def _present(df: DataFrame, embedding: str) -> DataFrame:
    """The rows that have a vector, with side columns for the commonest metadata keys."""
    rows = df.filter(F.col(embedding).isNotNull())
    return shred_metadata(rows) if "metadata" in df.columns else rows


def _neighbours(sample: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of sampled queries, and of their nearest rows in the sample."""
    asked = np.arange(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES))
    found = all_pairs(metric, sample[asked], sample)
    found = np.where(np.isnan(found), np.inf, found)
    return asked, np.argsort(found, axis=1, kind="stable")[:, :DEFAULT_K]


class _Index:
    kind: str
    metric: str
    table: DataFrame
    total: int
    id_col: str
    embedding: str

    def _check(self, metric: str | None) -> None:
        if metric is not None and metric != self.metric:
            raise ValueError(f"index was built for {self.metric}, not {metric}")

    def _widen(self, found: Callable[[int], DataFrame], start: int, end: int, k: int) -> DataFrame:
        """Candidates of the smallest probed width that yields ``k`` rows, or of all."""
        width = start
        while width < end and not has_rows(found(width), k):
            width = min(end, width * 2)
        return found(width)

    def _rerank(self, candidates, query, k, columns, decimals) -> DataFrame:
        return similarity_search(
            candidates, query, k, self.metric, None, columns, self.id_col, self.embedding,
            decimals=decimals,
        )

    def _batch(
        self, queries: DataFrame, query_id: str, k: int, start: int, end: int,
        buckets: Callable[[DataFrame, int], DataFrame], corpus: DataFrame, decimals: int | None,
    ) -> DataFrame:
        """Nearest rows of a whole query table, which meets the corpus by bucket.

        Queries with fewer rows than there are to be had go on to four times as many
        buckets, the others are done. ``buckets`` adds the column to (id, embedding).
        """
        pending = queries.filter(F.col(self.embedding).isNotNull()).select(
            F.col(query_id).cast("long").alias("id"), F.col(self.embedding).alias("embedding")
        )
        wanted, width, done = min(k, self.total), min(start, end), []
        while True:
            found = stage(top_k(bucket_candidates(corpus, buckets(pending, width), k, self.metric, decimals), k), "ann")
            full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= wanted)
            if width >= end or full.count() == pending.count():
                break
            done.append(found.join(full, "query_id", "left_semi"))
            pending = stage(pending.join(full, pending.id == full.query_id, "left_anti"), "ann-pending")
            width = min(end, 4 * width)
        for rows in done:
            found = found.unionByName(rows)
        return found

    def _save(self, path: str, **values) -> None:
        rows = self.table.sparkSession.createDataFrame(
            [(self.kind, self.metric, self.total, self.id_col, self.embedding, self.table.schema.json(),
              {k: (list(map(int, np.shape(v))), np.asarray(v, float).ravel().tolist()) for k, v in values.items()})],
            "kind string, metric string, total long, id_col string, embedding string, schema string, "
            "values map<string, struct<shape: array<long>, flat: array<double>>>",
        )
        rows.coalesce(1).write.parquet(f"{path}/model")


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, np.ndarray], tuple]:
    """Rows, arrays and plain settings of an index folder."""
    row = spark.read.parquet(f"{path}/model").first()
    values = {k: np.array(v["flat"]).reshape(v["shape"]) for k, v in row["values"].items()}
    table = spark.read.schema(StructType.fromJson(json.loads(row["schema"]))).parquet(f"{path}/rows")
    return table, values, (row["total"], row["metric"], row["id_col"], row["embedding"], path)


class IvfIndex(_Index):
    """Corpus partitioned by k-means cell; built for one metric.

    k-means knows euclidean cells only: cosine uses unit vectors (same order), inner
    product and Manhattan use the euclidean cells and rely on the re-rank. With many cells there are
    two levels: folders are the cells of a coarse model, and each is cut into cells
    of its own, by which its files are sorted.
    """

    kind = "ivfflat"

    def __init__(self, table, cells, probes, total, metric, id_col, embedding, path=None):
        self.table, self.cells, self.probes = table, cells, probes
        self.total, self.metric = total, metric
        self.id_col, self.embedding, self.path = id_col, embedding, path

    @classmethod
    def build(
        cls,
        df: DataFrame,
        lists: int | None = None,
        metric: str = DEFAULT_METRIC,
        id_col: str = "id",
        embedding: str = "embedding",
        path: str | None = None,
        seed: int = 42,
        train_fraction: float | None = None,
    ) -> IvfIndex:
        """Train cells and write the partitioned corpus.

        ``lists`` cells, by default the square root of the number of rows. They are trained from
        about ``ROWS_PER_LIST`` rows each, or from the ``train_fraction`` the caller asks for;
        every row is assigned and kept. The rebalance hint splits a folder that holds much of
        the corpus over several writing tasks.
        """
        check_metric(metric)
        present = _present(df, embedding)
        vectors = present.select(F.col(embedding).cast("array<double>").alias("vector"))
        total = vectors.count()
        if lists is None:
            lists = min(MAX_LISTS, max(1, round(total**0.5)))
        fraction = train_fraction if train_fraction is not None else min(1.0, lists * ROWS_PER_LIST / max(total, 1))
        if fraction < 1:
            # written once: the training passes then read the sample, not the corpus
            train = stage(vectors.sample(fraction=fraction, seed=seed), "ivf-train")
        else:
            train = vectors
        cells = cls._train(train, lists, metric, seed) if total else Cells(np.zeros((1, 1)), np.zeros(1), np.zeros((0, 1)), metric)
        shared = df.sparkSession.sparkContext.broadcast(cells)  # at most MAX_LISTS centers

        @F.arrow_udf("int")
        def cell(batch: pa.Array) -> pa.Array:
            return pa.array(shared.value.assign(matrix(batch, shared.value.centers.shape[1])).astype(np.int32))

        @F.arrow_udf("int")
        def parent(batch: pa.Array) -> pa.Array:
            return pa.array(shared.value.parents[np.asarray(batch)].astype(np.int32))

        placed, folder = present.withColumn("cell", cell(F.col(embedding))), "cell"
        if len(cells.tops):
            folder = "coarse"
            placed = placed.withColumn(folder, parent(F.col("cell")))
        path = path or new_path(df.sparkSession, "ivf")
        dealt = placed.hint("rebalance", folder)
        if len(cells.tops):
            dealt = dealt.sortWithinPartitions("coarse", "cell")
        dealt.write.options(**bloom_options(placed)).partitionBy(folder).parquet(f"{path}/rows")
        table = df.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
        probes = cls._probes(_sample(vectors, SAMPLE_ROWS, total, seed), cells) if total else 1
        index = cls(table, cells, probes, total, metric, id_col, embedding, path)
        index._save(path, centers=cells.centers, parents=cells.parents, tops=cells.tops, probes=probes)
        return index

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IvfIndex:
        table, values, plain = _stored(spark, path)
        cells = Cells(values["centers"], values["parents"].astype(np.int64), values["tops"], plain[1])
        return cls(table, cells, int(values["probes"]), *plain)

    @staticmethod
    def _train(train: DataFrame, lists: int, metric: str, seed: int) -> Cells:
        features = train.select("vector", array_to_vector("vector").alias("features"))
        if metric == "cosine":
            features = Normalizer(inputCol="features", outputCol="unit", p=2.0).transform(features).select(
                "vector", F.col("unit").alias("features")
            )
        first = lists if lists <= DIRECT_LISTS else round(lists**0.5)
        centers = np.array(KMeans(k=first, seed=seed, maxIter=10).fit(features.select("features")).clusterCenters())
        if first == lists:
            return Cells(centers, np.arange(len(centers)), np.zeros((0, centers.shape[1])), metric)
        fine = -(-lists // len(centers))

        @F.arrow_udf("int")
        def coarse(batch: pa.Array) -> pa.Array:
            found = nearest_cells(centers, metric, matrix(batch, centers.shape[1]), 1)
            return pa.array(found[:, 0].astype(np.int32))

        # a coarse cell is trained from a bounded number of its rows, also where it holds most of them
        placed = train.withColumn("coarse", coarse(F.col("vector")))
        order = Window.partitionBy("coarse").orderBy(F.xxhash64("vector"))
        few = placed.dropDuplicates(["vector"]).withColumn("n", F.row_number().over(order)).filter(
            F.col("n") <= fine * ROWS_PER_LIST
        )

        def refine(key: tuple, rows: pa.Table) -> pa.Table:
            points = _points(metric, matrix(rows["vector"].combine_chunks(), None))
            found = local_kmeans(points, fine, seed)
            return pa.table({"coarse": pa.array(np.full(len(found), key[0].as_py(), np.int32)), "center": _lists(found)})

        cells = few.select("coarse", "vector").groupBy("coarse").applyInArrow(refine, "coarse int, center array<double>")
        found = cells.toArrow().sort_by("coarse")  # at most about ``lists`` rows
        own = matrix(found["center"].combine_chunks(), None)
        return Cells(own, found["coarse"].to_numpy().astype(np.int64), centers, metric)

    @staticmethod
    def _probes(sample: np.ndarray, cells: Cells) -> int:
        """How many cells hold ``TARGET`` of the sample's neighbours."""
        asked, found = _neighbours(sample, cells.metric)
        own, order = cells.assign(sample), cells.nearest(sample[asked])
        place = np.argsort(order, axis=1)
        return 1 + int(np.quantile(np.take_along_axis(place, own[found], axis=1), TARGET, method="higher"))

    @property
    def lists(self) -> int:
        return len(self.cells.centers)

    def search(
        self,
        query: Sequence[float],
        k: int = DEFAULT_K,
        probes: int | None = None,
        filters: Mapping[str, Any] | None = None,
        metric: str | None = None,
        columns: Sequence[str] = ("id", "content", "metadata"),
        decimals: int | None = None,
    ) -> DataFrame:
        """Nearest rows among the ``probes`` nearest cells; only these are read.

        Probes double until ``k`` rows pass the filter or all cells are in.
        """
        self._check(metric)
        point = np.asarray([query], dtype=np.float64)
        cells = self.cells.nearest(point)[0] if self.total else np.arange(1)

        def found(width: int) -> DataFrame:
            chosen = cells[:width]
            rows = self.table.filter(F.col("cell").isin(chosen.tolist()))
            if "coarse" in self.table.columns:
                rows = rows.filter(F.col("coarse").isin(np.unique(self.cells.parents[chosen]).tolist()))
            return metadata_filter(rows, filters)

        candidates = self._widen(found, max(1, probes or self.probes), len(cells), k)
        return self._rerank(candidates, query, k, columns, decimals)

    def knn_join(
        self, queries: DataFrame, k: int, probes: int | None = None, query_id: str = "id",
        decimals: int | None = None,
    ) -> DataFrame:
        """``search`` for a whole query table: queries go to their nearest cells and meet
        only the rows of these; every query gets ``k`` rows where there are as many."""
        shared = self.table.sparkSession.sparkContext.broadcast(self.cells)

        def buckets(asked: DataFrame, width: int) -> DataFrame:
            @F.arrow_udf("array<int>")
            def near(batch: pa.Array) -> pa.Array:
                vectors = matrix(batch, shared.value.centers.shape[1])
                return _lists(shared.value.nearest(vectors, width).astype(np.int32))

            return asked.withColumn("bucket", F.explode(near(F.col("embedding"))))

        corpus = self.table.select(
            F.col(self.id_col).alias("id"), F.col(self.embedding).alias("embedding"), F.col("cell").alias("bucket")
        )
        return self._batch(queries, query_id, k, probes or self.probes, self.lists, buckets, corpus, decimals)


def local_kmeans(points: np.ndarray, count: int, seed: int, rounds: int = 10) -> np.ndarray:
    """At most ``count`` centers of a matrix that fits one task."""
    centers = points[np.random.default_rng(seed).permutation(len(points))[:count]].copy()
    for _ in range(rounds):
        own = nearest_cells(centers, "l2", points, 1)[:, 0]
        sums, sizes = np.zeros_like(centers), np.bincount(own, minlength=len(centers))
        np.add.at(sums, own, points)
        centers = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centers)
    return centers


class Hyperplanes:
    """Codes of one or more hash tables: a bit says on which side of a hyperplane a vector lies.

    The directions of a table are orthogonal and the planes are set at the median of a sample, so buckets
    are about equally full. A bucket's gap to a vector is the squared distance of the vector from the bucket's
    part of space, a lower bound of that from any vector in it.
    """

    def __init__(self, directions: np.ndarray, thresholds: np.ndarray, metric: str):
        self.directions, self.thresholds, self.metric = directions, thresholds, metric  # (tables, dims, bits), (tables, bits)

    @classmethod
    def fit(cls, sample: np.ndarray, dims: int, metric: str, tables: int, bits: int, seed: int) -> Hyperplanes:
        random = np.random.default_rng(seed)
        bits = min(bits, dims)
        directions = np.stack([np.linalg.qr(random.standard_normal((dims, bits)))[0] for _ in range(tables)])
        points = _points(metric, sample.reshape(-1, dims))
        spots = np.einsum("nd,tdb->ntb", points, directions)
        return cls(directions, np.median(spots, axis=0) if len(points) else np.zeros((tables, bits)), metric)

    @property
    def tables(self) -> int:
        return len(self.directions)

    @property
    def bits(self) -> int:
        return self.directions.shape[2]

    def offsets(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, tables, bits): how far each vector lies beyond each plane."""
        points = _points(self.metric, vectors)
        # a fixed summation order per row keeps equal vectors in equal buckets
        spots = np.stack([
            np.stack([(points * self.directions[t][:, b]).sum(axis=1) for b in range(self.bits)], axis=1)
            for t in range(self.tables)
        ], axis=1)
        return spots - self.thresholds

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        return ((self.offsets(vectors) > 0) << np.arange(self.bits)[::-1]).sum(axis=2)

    def gaps(self, offsets: np.ndarray) -> np.ndarray:
        """Of all codes of one table to one vector, given the vector's offsets."""
        gap = np.zeros(1)
        for offset in offsets:
            off = max(offset * offset, 1e-300)  # on the plane itself its own side still comes first
            gap = (gap[:, None] + np.array([off, 0.0] if offset > 0 else [0.0, off])).ravel()
        return gap

    def nearest(self, offsets: np.ndarray, filled: np.ndarray, width: int) -> np.ndarray:
        """The ``width`` filled codes with the least gaps to one vector, given the vector's offsets in the table.

        Only the planes nearest to the vector are crossed at first: a code beyond any other plane has a gap of
        that plane's at least, so what is found below it is final. ``filled`` is sorted.
        """
        if width >= len(filled):
            return filled
        off = np.maximum(offsets * offsets, 1e-300)
        near, weights = np.argsort(off, kind="stable"), 1 << np.arange(self.bits)[::-1]
        home = int(((offsets > 0) * weights).sum())
        for crossed in range(min(self.bits, width.bit_length() - 1), self.bits, 2):
            codes, gap = np.array([home]), np.zeros(1)
            for b in near[:crossed]:
                codes, gap = np.concatenate([codes, codes ^ weights[b]]), np.concatenate([gap, gap + off[b]])
            place = np.minimum(np.searchsorted(filled, codes), len(filled) - 1)
            codes, gap = codes[filled[place] == codes], gap[filled[place] == codes]
            inside = gap < off[near[crossed]]
            if inside.sum() >= width:
                codes, gap = codes[inside], gap[inside]
                return codes[np.argpartition(gap, width - 1)[:width]]
        return filled[np.argpartition(self.gaps(offsets)[filled], width - 1)[:width]]

    def share(self, sample: np.ndarray) -> float:
        """Share of a table's rows, nearest buckets first, that holds ``TARGET`` of the sample's neighbours."""
        asked, found = _neighbours(sample, self.metric)
        codes, offsets = self.codes(sample), self.offsets(sample[asked])
        least = np.full(found.shape, np.inf)
        for t in range(self.tables):
            for n in range(len(asked)):
                gap = self.gaps(offsets[n, t])[codes[:, t]]
                least[n] = np.minimum(least[n], np.searchsorted(np.sort(gap), gap[found[n]], "right") / len(sample))
        return float(np.quantile(least, TARGET, method="higher"))


class LshIndex(_Index):
    """Posting lists of random-hyperplane buckets, which take the role of the graph indexes.

    The rows stand in the order of their bucket's code, in folders by hash table and leading bits. How many
    rows each bucket has is kept in a directory of at most 2 to the power of ``BITS`` numbers a table. A search
    takes the buckets nearest to the query, in the order of their boundaries' distance, until they hold the
    share of the rows that the sample asked for, and reads their folders only. Cosine hashes unit vectors;
    inner product and Manhattan rely on the re-rank. Each further hash table stores the rows once more.
    """

    kind = "hnsw"

    def __init__(self, table, planes, counts, share, total, metric, id_col, embedding, path=None):
        self.table, self.planes, self.counts, self.share = table, planes, counts, share
        self.total, self.metric = total, metric
        self.id_col, self.embedding, self.path = id_col, embedding, path

    @classmethod
    def build(
        cls,
        df: DataFrame,
        dims: int,
        metric: str = DEFAULT_METRIC,
        tables: int = 1,
        bits: int = BITS,
        id_col: str = "id",
        embedding: str = "embedding",
        path: str | None = None,
        seed: int = 42,
    ) -> LshIndex:
        """Place the planes by a sample of at most ``SAMPLE_ROWS`` rows, then write every row to its bucket."""
        check_metric(metric)
        if not 0 < bits <= BITS:
            raise ValueError(f"codes have 1 to {BITS} bits")
        present = _present(df, embedding)
        vectors = present.select(F.col(embedding).cast("array<double>").alias("vector"))
        total = vectors.count()
        sample = _sample(vectors, SAMPLE_ROWS, total, seed) if total else np.zeros((0, dims))
        planes = Hyperplanes.fit(sample, dims, metric, tables, bits, seed)
        hashed = present.select("*", F.posexplode(cls._hashed(planes)(F.col(embedding))).alias("hash_table", "code"))
        hashed = hashed.withColumn("folder", F.expr(f"shiftright(code, {max(0, planes.bits - FOLDER_BITS)})"))
        path = path or new_path(df.sparkSession, "lsh")
        dealt = hashed.hint("rebalance", "hash_table", "folder").sortWithinPartitions("hash_table", "folder", "code")
        dealt.write.options(**bloom_options(hashed)).partitionBy("hash_table", "folder").parquet(f"{path}/rows")
        table = df.sparkSession.read.schema(hashed.schema).parquet(f"{path}/rows")
        counts = np.zeros((tables, 1 << planes.bits), np.int64)
        sizes = table.groupBy("hash_table", "code").agg(F.count(F.lit(1)).alias("n")).toArrow()
        counts[sizes["hash_table"].to_numpy(), sizes["code"].to_numpy()] = sizes["n"].to_numpy()
        index = cls(table, planes, counts, planes.share(sample) if total else 1.0, total, metric, id_col, embedding, path)
        index._save(path, directions=planes.directions, thresholds=planes.thresholds, counts=counts, share=index.share)
        return index

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LshIndex:
        table, values, plain = _stored(spark, path)
        planes = Hyperplanes(values["directions"], values["thresholds"], plain[1])
        return cls(table, planes, values["counts"].astype(np.int64), float(values["share"]), *plain)

    @staticmethod
    def _hashed(planes: Hyperplanes):
        """The function that gives a vector its codes."""
        dims = planes.directions.shape[1]

        @F.arrow_udf("array<int>")
        def codes(batch: pa.Array) -> pa.Array:
            return _lists(planes.codes(matrix(batch, dims)).astype(np.int32))

        return codes

    def probed(self, query: Sequence[float], k: int = DEFAULT_K, share: float | None = None) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """Per hash table: the filled buckets nearest first, their gaps, and how many of them hold the share
        of the rows, ``k`` rows at least."""
        offsets = self.planes.offsets(np.asarray([query], dtype=np.float64))[0]
        result = []
        for t in range(self.planes.tables):
            gap = self.planes.gaps(offsets[t])
            filled = np.flatnonzero(self.counts[t])
            order = filled[np.argsort(gap[filled], kind="stable")]
            rows = np.cumsum(self.counts[t][order])
            enough = max(k, (self.share if share is None else share) * self.total)
            result.append((order, gap[order], min(len(order), 1 + int(np.searchsorted(rows, enough)))))
        return result

    def _rows(self, chosen: Iterable[np.ndarray]) -> DataFrame:
        """Rows of the chosen buckets of each hash table, each row once."""
        fold, rows, t = max(0, self.planes.bits - FOLDER_BITS), None, 0
        for t, codes in enumerate(chosen):
            folders = np.unique(codes >> fold)
            part = self.table.filter((F.col("hash_table") == t) & F.col("folder").isin(folders.tolist()))
            inside = np.flatnonzero(np.isin(np.arange(self.counts.shape[1]) >> fold, folders) & (self.counts[t] > 0))
            if len(inside) > len(codes):
                if len(codes) <= MAX_LITERALS:
                    part = part.filter(F.col("code").isin(codes.tolist()))
                else:  # at most 2 ** BITS numbers
                    few = self.table.sparkSession.createDataFrame(pa.table({"code": pa.array(codes.astype(np.int32))}))
                    part = part.join(F.broadcast(few), "code", "left_semi")
            rows = part if rows is None else rows.unionByName(part)
        return rows if t == 0 else rows.dropDuplicates([self.id_col])

    def search(
        self,
        query: Sequence[float],
        k: int = DEFAULT_K,
        filters: Mapping[str, Any] | None = None,
        metric: str | None = None,
        columns: Sequence[str] = ("id", "content", "metadata"),
        decimals: int | None = None,
        share: float | None = None,
        exact: bool = False,
    ) -> DataFrame:
        """Nearest rows among the nearest buckets that hold ``share`` of the rows; only these are read.

        With fewer than ``k`` rows that pass the filter twice as many buckets are taken, and so on. With
        ``exact``, for L2 and cosine, all buckets that are no farther than the ``k``-th row found are taken
        of one hash table in the end, which leaves nothing out.
        """
        self._check(metric)
        if exact and self.metric not in ("l2", "cosine"):
            raise ValueError(f"a bucket's distance bounds no {self.metric} distance")
        near = self.probed(query, k, share)
        longest = max((len(order) for order, _, _ in near), default=0)

        def found(width: int) -> DataFrame:
            return metadata_filter(self._rows(order[: n * width] for order, _, n in near), filters)

        candidates = self._widen(found, 1, max(1, longest), k)
        if exact:
            last = self._rerank(candidates, query, k, (self.id_col,), None).collect()
            far = last[-1]["distance"] if len(last) == k else np.inf
            reach = np.inf if not np.isfinite(far) else (far * far if self.metric == "l2" else 2 * far) * (1 + 1e-6) + 1e-9
            candidates = metadata_filter(self._rows(order[gap <= reach] for order, gap, _ in near[:1]), filters)
        return self._rerank(candidates, query, k, columns, decimals)

    def knn_join(
        self, queries: DataFrame, k: int, query_id: str = "id", decimals: int | None = None, probes: int = 1,
    ) -> DataFrame:
        """``search`` for a whole query table: queries go to their ``probes`` nearest filled buckets of each
        hash table and meet only the rows of these; every query gets ``k`` rows where there are as many."""
        planes, dims, size = self.planes, self.planes.directions.shape[1], self.counts.shape[1]
        filled = self.table.sparkSession.sparkContext.broadcast([np.flatnonzero(c) for c in self.counts])

        def buckets(asked: DataFrame, width: int) -> DataFrame:
            @F.arrow_udf("array<int>")
            def nearest(batch: pa.Array) -> pa.Array:
                vectors = matrix(batch, dims)
                offsets, lists = planes.offsets(vectors), []
                for n in range(len(vectors)):
                    own = []
                    for t, codes in enumerate(filled.value):
                        own.append(t * size + planes.nearest(offsets[n, t], codes, width))
                    lists.append(np.concatenate(own))
                ends = np.cumsum([0] + [len(x) for x in lists]).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists or [np.zeros(0)]).astype(np.int32)))

            return asked.withColumn("bucket", F.explode(nearest(F.col("embedding"))))

        corpus = self.table.select(
            F.col(self.id_col).alias("id"), F.col(self.embedding).alias("embedding"),
            (F.col("hash_table") * size + F.col("code")).alias("bucket"),
        )
        end = max((int((c > 0).sum()) for c in self.counts), default=1)
        return self._batch(queries, query_id, k, probes, max(1, end), buckets, corpus, decimals)


def create_index(df: DataFrame, index_type: str, metric: str = DEFAULT_METRIC, **options):
    """An index by the name of its kind; both graph kinds map to the bucket index."""
    if index_type not in INDEX_TYPES:
        raise ValueError(f"Unsupported index type: {index_type}")
    if index_type == "ivfflat":
        return IvfIndex.build(df, metric=metric, **options)
    return LshIndex.build(df, metric=metric, **options)


def load_index(spark: SparkSession, path: str) -> IvfIndex | LshIndex:
    """An index by its folder."""
    kind = spark.read.parquet(f"{path}/model").first()["kind"]
    return (IvfIndex if kind == IvfIndex.kind else LshIndex).load(spark, path)


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Share of each query's exact neighbours that the approximate result has."""
    hits = approximate.select("query_id", "id", F.lit(1).alias("hit"))
    return exact.join(hits, ["query_id", "id"], "left").groupBy("query_id").agg(
        F.count(F.lit(1)).alias("wanted"),
        F.count("hit").alias("found"),
        (F.count("hit") / F.count(F.lit(1))).alias("recall"),
    )
