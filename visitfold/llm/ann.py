"""Nearest vectors through learned partitions.

On a bounded sample: a graph of nearest neighbours is cut into balanced parts by recursive
spectral bisection with swaps, and a linear softmax classifier learns the part from the
vector. In a large table each part is cut again in the same way, on a sample of its own, so
parts keep their size while the table grows. Then every vector is indexed under its most
probable part, every query is routed to its most probable parts, and blocks of a part are
ranked exactly. How many parts a query visits is calibrated on vectors that no classifier has
seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitfold.llm.common import settle

#: Vectors that a graph and a classifier are fitted on, whatever the table's size.
SAMPLE = 4096
#: Further ones on which the number of visits is calibrated.
UNSEEN = 2048
NEIGHBOURS = 12
#: A part has about so many vectors; it is cut into MOST_PARTS at a time, twice at most.
PART_ROWS = 1000
MOST_PARTS = 128
#: Share of unseen vectors' neighbours that the visited parts must hold.
WANTED = 0.95
#: Vectors and queries that a task ranks at a time; a larger part is cut into blocks.
BLOCK_ROWS = 20_000
QUERY_ROWS = 4_000
#: Rounding of matrix products; pairs this near are compared by their own sums.
NEAR = 1e-9


def usable(vector: str) -> Column:
    """Holds numbers only, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two: cosines stay the same, squares neither vanish nor overflow."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def neighbour_graph(points: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other points of every point, nearest first."""
    n = len(points)
    k = min(k, n - 1)
    near = np.empty((n, k), np.int64)
    for a in range(0, n, 256):
        score = points[a : a + 256] @ points.T
        score[np.arange(len(score)), np.arange(a, a + len(score))] = -np.inf
        top = np.argpartition(-score, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable")
        near[a : a + 256] = np.take_along_axis(top, order, 1)
    return near


def bisect(nodes: np.ndarray, near: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which half (of equal size) each node goes to, cutting few neighbour links."""
    n = len(nodes)
    place = np.full(len(near), -1)
    place[nodes] = np.arange(n)
    to = place[near[nodes]]
    a = np.repeat(np.arange(n), to.shape[1])[to.ravel() >= 0]
    b = to.ravel()[to.ravel() >= 0]
    left, right = np.concatenate((a, b)), np.concatenate((b, a))
    degree = np.bincount(left, minlength=n) + 1.0
    value = rng.standard_normal(n)
    for _ in range(60):
        value = value / degree + np.bincount(left, value[right] / degree[right], n)
        value -= value.mean()
        value /= np.abs(value).max() or 1.0
    side = np.zeros(n, np.int64)
    side[np.argsort(value, kind="stable")[n // 2 :]] = 1
    for _ in range(20):
        across = np.bincount(left, side[left] != side[right], n)
        gain = 2 * across - (degree - 1)
        one, other = (np.flatnonzero(side == s) for s in (0, 1))
        one = one[np.argsort(-gain[one], kind="stable")]
        other = other[np.argsort(-gain[other], kind="stable")]
        m = min(len(one), len(other))
        swaps = np.flatnonzero(gain[one[:m]] + gain[other[:m]] > 0)[: max(1, n // 50)]
        if not len(swaps):
            break
        before, trial = across.sum(), side.copy()
        trial[one[swaps]], trial[other[swaps]] = 1, 0
        if (trial[left] != trial[right]).sum() >= before:
            break
        side = trial
    return side


def balanced_parts(near: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """Parts (a power of two) of equal size."""
    rng = np.random.default_rng(seed)
    label = np.zeros(len(near), np.int64)
    made = 1
    while made < parts:
        for part in range(made):
            nodes = np.flatnonzero(label == part)
            if len(nodes) > 1:
                label[nodes] = 2 * part + bisect(nodes, near, rng) + 2 * made
        label -= 2 * made * (label >= 2 * made)
        made *= 2
    return label


def log_shares(points: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log-probabilities of a classifier's parts."""
    logits = points @ weights[:-1] + weights[-1]
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Router:
    """Weights of the classifiers, and the number of parts that a query visits.

    ``inner`` has a classifier for each part of the first one, all with equally many parts.
    """

    weights: np.ndarray
    probes: int
    inner: tuple[np.ndarray, ...] = ()

    @property
    def parts(self) -> int:
        return self.weights.shape[1] * (self.inner[0].shape[1] if self.inner else 1)

    def home(self, points: np.ndarray) -> np.ndarray:
        """The part under which each vector is indexed."""
        first = log_shares(points, self.weights).argmax(axis=1)
        if not self.inner:
            return first
        out = np.empty(len(points), np.int64)
        for part, weights in enumerate(self.inner):
            at = np.flatnonzero(first == part)
            if len(at):
                out[at] = part * weights.shape[1] + log_shares(points[at], weights).argmax(axis=1)
        return out

    def ranked(self, points: np.ndarray, count: int) -> np.ndarray:
        """The most probable parts of each vector."""
        shares = log_shares(points, self.weights)
        if self.inner:
            inside = [log_shares(points, weights) for weights in self.inner]
            shares = np.concatenate([shares[:, [k]] + one for k, one in enumerate(inside)], axis=1)
        return np.argsort(-shares, axis=1, kind="stable")[:, :count]


def train_classifier(points: np.ndarray, label: np.ndarray, parts: int, steps: int = 200) -> np.ndarray:
    """Softmax regression by Adam on all points."""
    inputs = np.hstack((points, np.ones((len(points), 1))))
    weights = np.zeros((inputs.shape[1], parts))
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    row = np.arange(len(points))
    for step in range(1, steps + 1):
        logits = inputs @ weights
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[row, label] -= 1
        slope = inputs.T @ p / len(points)
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope * slope
        weights -= 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights


def split(points: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """The classifier of so many balanced parts (a power of two) of the neighbour graph of points."""
    if parts == 1 or len(points) < 2 * parts:
        return np.zeros((points.shape[1] + 1, parts))
    near = neighbour_graph(points, NEIGHBOURS)
    return train_classifier(points, balanced_parts(near, parts, seed), parts)


def how_many(rows: int, part_rows: int, most: int) -> int:
    """Parts, a power of two, that leave about ``part_rows`` in each, at most so many."""
    parts = 1
    while 2 * parts <= most and parts * part_rows < rows:
        parts *= 2
    return parts


def calibrated(router: Router, points: np.ndarray, k: int, wanted: float) -> Router:
    """The router with as many visits as find that share of the points' k nearest among them, and one more."""
    if router.parts == 1 or len(points) < 2:
        return replace(router, probes=router.parts)
    near = neighbour_graph(points, k)
    order = router.ranked(points, router.parts)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(router.parts)[None, :].repeat(len(order), 0), 1)
    visits = np.take_along_axis(rank, router.home(points)[near], 1).ravel()
    probes = int(np.quantile(visits, wanted, method="higher")) + 1
    return replace(router, probes=min(router.parts, probes + 1))


def _routed(vectors: DataFrame, router: Router, count: int, key: str) -> DataFrame:
    """``key``, vector as doubles, and the ``count`` most probable parts, a row for each; 0 is its home."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                held = pa.concat_arrays([batch.column("vector")])
                values = held.flatten().to_numpy(zero_copy_only=False)
                points = values.reshape(batch.num_rows, -1).astype(np.float64)
                order = router.ranked(unit(points), count) if count else router.home(unit(points))[:, None]
                row = np.repeat(np.arange(len(points)), order.shape[1])
                raw = pa.array([point.tobytes() for point in points], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).take(pa.array(row)),
                        raw.take(pa.array(row)),
                        pa.array(order.ravel().astype(np.int32)),
                    ],
                    names=[key, "vector", "part"],
                )

    return vectors.select(key, "vector").mapInArrow(work, f"{key} long, vector binary, part int")


def rank_block(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best vectors of a block for each query, as query_id, vec_id, score.

    Equal vectors are ranked once; of each the smallest k + 1 ids can matter.
    """
    names = ["query_id", "vec_id", "score"]
    if not len(queries) or not len(vectors):
        return pd.DataFrame({n: pd.Series(dtype=t) for n, t in zip(names, ("int64", "Int64", "float64"))})
    vectors = vectors.drop_duplicates(["vec_id", "vector"])
    queries = queries.drop_duplicates(["query_id", "vector"])
    groups = vectors.sort_values("vec_id", na_position="last").groupby("vector", sort=False)["vec_id"]
    heads = vectors.loc[groups.head(k + 1).index].sort_values("vec_id", na_position="last")
    code, raw = pd.factorize(heads["vector"])
    table = scaled(np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1))
    asked = scaled(np.frombuffer(b"".join(queries["vector"]), np.float64).reshape(len(queries), -1))
    size = np.sqrt((table * table).sum(axis=1))
    asked_size = np.sqrt((asked * asked).sum(axis=1))
    by_code = np.argsort(code, kind="stable")
    begin = np.searchsorted(code[by_code], np.arange(len(raw) + 1))
    ids, own = heads["vec_id"].to_numpy(), queries["query_id"].to_numpy()
    found = []
    for a in range(0, len(asked), 128):
        some = asked[a : a + 128]
        score = (some / asked_size[a : a + 128, None]) @ (table / size[:, None]).T
        least = np.full(len(some), -np.inf)
        if score.shape[1] > k + 1:
            least = np.partition(score, -(k + 1), axis=1)[:, -(k + 1)] - NEAR
        q, u = np.nonzero(score >= least[:, None])
        exact = (some[q] * table[u]).sum(axis=1) / (asked_size[a + q] * size[u])
        count = begin[u + 1] - begin[u]
        at = by_code[np.repeat(begin[u], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        part = pd.DataFrame(
            {
                "query_id": np.repeat(own[a + q], count),
                "row": np.repeat(q, count),
                "vec_id": ids[at],
                "score": np.repeat(exact, count),
            }
        )
        part = part[(part["vec_id"] != part["query_id"]) | part["vec_id"].isna()]
        part = part.sort_values(["score", "vec_id"], ascending=[False, True], na_position="last")
        found.append(part.groupby("row", sort=False).head(k))
    return pd.concat(found)[names]


def _search(indexed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Best k of every query over the parts it visits; parts are cut into bounded blocks."""
    counts = lambda rows, most: (  # noqa: E731  a row for each part, at most MOST_PARTS squared
        rows.groupBy("part").agg(F.ceil(F.count("*") / most).cast("int").alias("cuts"))
    )
    cuts = counts(indexed, BLOCK_ROWS).withColumnRenamed("cuts", "blocks").join(
        counts(asked, QUERY_ROWS).withColumnRenamed("cuts", "turns"), "part"
    )
    cut = lambda n, *by: F.pmod(F.xxhash64(*by), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    vectors = indexed.join(F.broadcast(cuts), "part").select(
        "part", "vec_id", "vector", cut(F.col("blocks"), "vec_id", "vector").alias("block"), every("turns").alias("turn")
    )
    queries = asked.join(F.broadcast(cuts), "part").select(
        "part", "query_id", "vector", every("blocks").alias("block"), cut(F.col("turns"), "query_id").alias("turn")
    )
    groups = ("part", "block", "turn")

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right["vec_id"] = right["vec_id"].astype("Int64")
        return rank_block(left, right, k)

    return (
        queries.groupBy(*groups)
        .cogroup(vectors.groupBy(*groups))
        .applyInPandas(work, "query_id long, vec_id long, score double")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    sample: int = SAMPLE,
    wanted: float = WANTED,
    part_rows: int = PART_ROWS,
    most_parts: int = MOST_PARTS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k vectors nearest to each query.

    Both tables have ``vec_id`` and ``vector`` columns; nearness is the cosine, ties go to
    the smaller id, a null id last. Every vector is indexed. A query that finds fewer than k
    vectors in the parts it visits searches all parts. Vectors that are null, empty, zero or
    hold null or non-finite parts take no part; vectors of another length than the query's
    are no candidates. A query does not find its own id; repeated rows name an id once;
    queries with a null id are left out, and empty tables give no rows.
    """
    clean = lambda rows, name: (
        rows.select(
            rows[f"`{vec_id}`"].cast("long").alias(name),
            rows[f"`{vector}`"].cast("array<double>").alias("vector"),
        ).where(usable("vector"))
    )
    base = clean(vectors, "vec_id")
    asked = clean(queries, "query_id").where("query_id IS NOT NULL")
    sizes = asked.select(F.size("vector").alias("n")).distinct().collect()
    out = None
    for n in sorted(row["n"] for row in sizes):
        of = lambda rows: rows.where(F.size("vector") == n)
        some = _nearest_of(of(base), of(asked), k, router_of(of(base), k, sample, wanted, part_rows, most_parts))
        out = some if out is None else out.unionByName(some)
    if out is None:
        schema = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], schema)
    return out


def router_of(
    base: DataFrame,
    k: int,
    sample: int = SAMPLE,
    wanted: float = WANTED,
    part_rows: int = PART_ROWS,
    most_parts: int = MOST_PARTS,
) -> Router | None:
    """The router of a table of vec_id and vector; none without rows.

    Vectors are sampled by the order of a hash. Those that come after the sample calibrate the
    visits; a table that has too few more is calibrated on the sample itself.
    """
    mixed = [F.xxhash64("vector", "vec_id"), F.col("vec_id")]
    rows = base.count()
    if not rows:
        return None
    picked = base.orderBy(*mixed).limit(sample + UNSEEN).select("vector").toPandas()
    points = unit(np.stack(picked["vector"].to_list()).astype(np.float64))
    parts = how_many(rows, part_rows, min(most_parts, max(1, min(sample, len(points)) // 32)))
    router = Router(split(points[:sample], parts), parts)
    within = how_many(-(-rows // parts), 2 * part_rows, most_parts)
    if parts == most_parts and within > 1:
        router = replace(router, inner=_inner(base, router, within, sample))
    unseen = points[sample:]
    return calibrated(router, unseen if len(unseen) >= 256 else points[:sample], k, wanted)


def _inner(base: DataFrame, router: Router, parts: int, sample: int) -> tuple[np.ndarray, ...]:
    """Classifiers within the parts of a router, each fitted in a task of its own on a bounded sample."""
    order = Window.partitionBy("part").orderBy(F.xxhash64("vector", "vec_id"), "vec_id")
    some = _routed(base, router, 0, "vec_id").withColumn("place", F.row_number().over(order))
    shape = router.weights.shape[0]

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        points = unit(np.frombuffer(b"".join(rows["vector"]), np.float64).reshape(len(rows), -1))
        fitting = how_many(len(points), 32, parts)
        weights = np.full((shape, parts), 0.0)
        weights[-1, fitting:] = -1e9  # parts that so few vectors do not fill
        weights[:, :fitting] = split(points, fitting)
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "weights": [weights.tobytes()]})

    found = some.where(F.col("place") <= sample).groupBy("part").applyInPandas(work, "part int, weights binary")
    held = {row["part"]: np.frombuffer(row["weights"]).reshape(shape, parts) for row in found.collect()}
    return tuple(held.get(part, np.zeros((shape, parts))) for part in range(router.weights.shape[1]))


def _nearest_of(base: DataFrame, asked: DataFrame, k: int, router: Router | None) -> DataFrame:
    """Vectors and queries of one length."""
    if router is None:
        return _best(base.selectExpr("vec_id AS query_id", "vec_id", "0D AS score").limit(0), k).select(
            "query_id", "rank", "vec_id", "score"
        )
    indexed = settle(_routed(base, router, 0, "vec_id"), "ann-index")
    visits = settle(_routed(asked, router, router.probes, "query_id"), "ann-queries")
    first = settle(_best(_search(indexed, visits, k), k), "ann-found")
    if router.probes < router.parts:
        lacking = asked.join(
            first.groupBy("query_id").count().where(F.col("count") >= k), "query_id", "left_anti"
        )
        lacking = settle(_routed(lacking, router, router.parts, "query_id"), "ann-lacking")
        if not lacking.isEmpty():
            again = _best(_search(indexed, lacking, k), k)
            first = first.join(again.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)
    return first.select("query_id", "rank", "vec_id", "score")
