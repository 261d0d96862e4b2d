"""Exact top-k search by integer inner product: ball trees per shard, searched in waves.

Components x become floor(256 * x), x as double.  Rows of equal vectors score alike, so of each distinct
vector only the k + 1 smallest ids are candidates, and equal queries are searched once.

* **Shards.**  Splitting planes fitted on at most SAMPLE vectors deal all candidates into shards
  of about SHARD_ROWS rows; near copies are cut like others, as the sample follows them.
  Each shard is built into a ball tree, whose leaves are stored as rows with the ball (centre and
  radius) of every node from the root to them.
* **Search.**  A query's inner product with anything in a ball is at most that with the centre
  plus the query's length times the radius.  The queries come in blocks of at most BLOCK_BYTES,
  a block being broadcast to all shards; a query first searches the shard with the highest
  bound, then the next ones, then all others, and each wave gets the k-th scores of the one
  before, below which shards, nodes and leaves are skipped.  In a task every query takes the leaves
  in the order of their bounds and raises its own k-th score on the way.

Scores are exact: products of doubles while they stay below 2**53, else Python's integers, cut
to the range of a long.  Bounds have a slack above rounding.  Nothing is approximate, so the
sample, shards and waves change the time alone; where vectors point anywhere without clusters,
bounds skip little and the work is that of all inner products.

Defined cases: a null vector, one with a null or a component that is not finite (also after the
scaling), takes no part.  Vectors of different length have no product and are not compared.
An empty vector scores 0 with other empty ones.  Every row is a candidate and every row whose id divides a
query; a query leaves out its own row, not copies of it under the same id.  Ties go to the smaller id, a
null id last; a null id asks nothing.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm.components import save
from rollbook.session import workspace

SAMPLE = 32_768  # vectors that the shards' planes are fitted on, about
SHARD_ROWS = 16_384
MOST_SHARDS = 4_096  # beyond, shards are cut into parts of SHARD_ROWS by hash
LEAF_ROWS = 256
BLOCK_BYTES = 32 << 20  # of query vectors searched at a time
SECOND = 8  # shards of the second wave, by bound
CHUNK = 2_048  # queries handled at a time in a task
EXACT = float(1 << 52)
LONG = (1 << 63) - 1
SMALL = 1 << 15  # components below this are packed in two bytes


@dataclass
class Split:
    """A node of the tree over shards: a plane, or the number of a shard."""

    plane: np.ndarray | None = None
    at: float = 0.0
    below: Split | None = None
    above: Split | None = None
    shard: int = -1


def direction(x: np.ndarray) -> np.ndarray:
    """From the point farthest from the centre to the one farthest from that."""
    first = x[((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    second = x[((x - first) ** 2).sum(axis=1).argmax()]
    return second - first


def fit_shards(sample: np.ndarray, shards: int) -> Split:
    """Planes that cut the sample into ``shards`` parts of the same size."""
    numbers = iter(range(shards))

    def cut(x: np.ndarray, n: int) -> Split:
        if n == 1 or len(x) < 2:
            return Split(shard=next(numbers))
        plane = direction(x)
        place = x @ plane
        order = np.argsort(place, kind="stable")
        middle = len(x) * (n // 2) // n
        low, high = order[:middle], order[middle:]
        return Split(plane, float(place[high[0]]), cut(x[low], n // 2), cut(x[high], n - n // 2))

    return cut(sample, shards)


def shard_of(tree: Split, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int32)

    def go(node: Split, rows: np.ndarray) -> None:
        if node.plane is None:
            out[rows] = node.shard
        elif len(rows):
            high = x[rows] @ node.plane >= node.at
            go(node.below, rows[~high])
            go(node.above, rows[high])

    go(tree, np.arange(len(x)))
    return out


def pack(x: np.ndarray) -> list[bytes]:
    """Each row's components: two bytes each if all are small, else doubles.  Equal vectors
    have equal bytes."""
    small = (np.abs(x) < SMALL).all(axis=1)
    short = x.astype("<i2") if small.all() else np.where(small[:, None], x, 0).astype("<i2")
    return [(short[i] if s else x[i]).tobytes() for i, s in enumerate(small.tolist())]


def unpack(column: pa.Array, dim: int) -> np.ndarray:
    packed = column.to_pylist()
    return np.stack([
        np.frombuffer(b, "<i2" if len(b) == 2 * dim else "<f8").astype(np.float64) for b in packed
    ]) if packed else np.zeros((0, dim))


def scaled(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(vec_id, dim, x) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("x")
            sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes[sizes >= 0]).tolist():
                rows = np.flatnonzero(sizes == dim)
                flat = lists.take(pa.array(rows)).flatten()
                x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(256 * x) + 0.0  # no negative zero
                good = np.isfinite(x).all(axis=1)  # a null has become NaN
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows[good])),
                     pa.array(np.full(int(good.sum()), dim, np.int32)), pa.array(pack(x[good]), pa.binary())],
                    names=["vec_id", "dim", "x"],
                )

    return vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x")
    ).mapInArrow(run, "vec_id long, dim int, x binary")


def ball(x: np.ndarray) -> np.ndarray:
    """Centre and radius, a little large."""
    centre = x.mean(axis=0)
    return np.append(centre, reach(x, centre).max(initial=0))


def reach(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6


def bounds(queries: np.ndarray, balls: np.ndarray) -> np.ndarray:
    """The highest score that each query can have in each ball, a little high."""
    centres, radii = balls[:, :-1], balls[:, -1]
    sizes = np.sqrt((queries ** 2).sum(axis=1))
    slack = 1 + 1e-9 * np.outer(sizes, np.sqrt((centres ** 2).sum(axis=1)) + radii)
    return queries @ centres.T + np.outer(sizes, radii) + slack


def grown(x: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, list[int]]]]:
    """A ball tree: the balls of its nodes, and its leaves as (rows, nodes from the root down)."""
    balls: list[np.ndarray] = []
    leaves: list[tuple[np.ndarray, list[int]]] = []

    def grow(rows: np.ndarray, above: list[int]) -> None:
        path = [*above, len(balls)]
        balls.append(ball(x[rows]))
        if len(rows) <= LEAF_ROWS:
            leaves.append((rows, path))
            return
        order = rows[np.argsort(x[rows] @ direction(x[rows]), kind="stable")]
        grow(order[: len(order) // 2], path)
        grow(order[len(order) // 2 :], path)

    grow(np.arange(len(x)), [])
    return np.stack(balls), leaves


LEAF = "shard int, part int, nodes array<int>, balls binary, vec_ids array<long>, x binary"


def plant(dim: int):
    """The leaves of one shard's tree, each with the balls on its way from the root."""

    def build(shard: pa.Table) -> pa.Table:
        x = unpack(shard["x"].combine_chunks(), dim)
        balls, leaves = grown(x)
        ids = shard["vec_id"].combine_chunks()
        n = len(leaves)
        return pa.table({
            "shard": pa.repeat(shard["shard"][0], n), "part": pa.repeat(shard["part"][0], n),
            "nodes": pa.array([path for _, path in leaves], pa.list_(pa.int32())),
            "balls": pa.array([balls[path].tobytes() for _, path in leaves], pa.binary()),
            "vec_ids": pa.array([ids.take(pa.array(rows)).to_pylist() for rows, _ in leaves], pa.list_(pa.int64())),
            "x": pa.array([x[rows].tobytes() for rows, _ in leaves], pa.binary()),
        })

    return build


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    def longest(m: np.ndarray) -> float:
        return float(np.sqrt((m ** 2).sum(axis=1).max(initial=0)))

    if longest(q) * longest(x) < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    big = whole(q).dot(whole(x).T)
    return np.frompyfunc(lambda v: max(-LONG, min(LONG, v)), 1, 1)(big).astype(np.int64)


def squares(x: np.ndarray) -> np.ndarray:
    """Each vector's product with itself."""
    if float((x ** 2).sum(axis=1).max(initial=0)) < EXACT:
        return (x ** 2).sum(axis=1).astype(np.int64)
    return np.array([products(row[None], row[None])[0, 0] for row in x], np.int64)


@dataclass
class Found:
    """Rows found for queries, by place of the query in its block."""

    query: np.ndarray
    score: np.ndarray
    missing: np.ndarray  # has the row no id?
    vec_id: np.ndarray
    square: np.ndarray  # the row's product with itself

    @staticmethod
    def none() -> Found:
        return Found(*(np.zeros(0, kind) for kind in (np.int64, np.int64, bool, np.int64, np.int64)))

    def best(self, more: list[Found], keep: int) -> Found:
        """The first ``keep`` of every query, by falling score, then by id."""
        parts = [self, *more]
        every = {f.name: np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Found)}
        # ~score falls as the score rises, and cannot overflow.
        order = np.lexsort((every["vec_id"], every["missing"], ~every["score"], every["query"]))
        if len(order):
            query = every["query"][order]
            first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
            rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
            order = order[rank < keep]
        return Found(**{name: values[order] for name, values in every.items()})

    def raised(self, least: np.ndarray, keep: int) -> np.ndarray:
        """What each query must reach now: the last score of ``keep``, or what it was."""
        out = least.copy()
        size = np.bincount(self.query, minlength=len(least))
        last = np.cumsum(size) - 1
        full = size == keep
        out[full] = np.maximum(out[full], self.score[last[full]])
        return out


@dataclass
class Leaf:
    nodes: list[int]
    balls: np.ndarray
    x: np.ndarray
    vec_id: np.ndarray
    missing: np.ndarray
    square: np.ndarray


def search_tree(queries: np.ndarray, least: np.ndarray, leaves: list[Leaf], keep: int) -> Found:
    """Best rows of a shard.  In each round every query goes to its next leaf by upper
    bound; it is done when that is below its last score."""
    balls = {node: ball for leaf in leaves for node, ball in zip(leaf.nodes, leaf.balls)}
    place = {node: i for i, node in enumerate(balls)}
    by_node = bounds(queries, np.stack(list(balls.values())))
    # A leaf is no better than any node above it.
    high = np.stack([by_node[:, [place[n] for n in leaf.nodes]].min(axis=1) for leaf in leaves], axis=1)
    order = np.argsort(-high, axis=1, kind="stable")
    found, alive = Found.none(), np.arange(len(queries))
    for turn in range(len(leaves)):
        next_leaf = order[alive, turn]
        going = high[alive, next_leaf] >= least[alive]
        alive, next_leaf = alive[going], next_leaf[going]
        if not len(alive):
            break
        hits = []
        for i in np.unique(next_leaf).tolist():
            mine, leaf = alive[next_leaf == i], leaves[i]
            score = products(queries[mine], leaf.x)
            q, r = np.nonzero(score >= least[mine][:, None])
            hits.append(Found(mine[q], score[q, r], leaf.missing[r], leaf.vec_id[r], leaf.square[r]))
        found = found.best(hits, keep)
        least = found.raised(least, keep)
    return found


@dataclass
class Block:
    """Some queries: their numbers, vectors, first shards by bound, and the scores to reach."""

    number: np.ndarray
    x: np.ndarray
    route: np.ndarray
    least: np.ndarray


def wave(leaves: DataFrame, block: Block, balls: np.ndarray, step: int, keep: int) -> DataFrame:
    """(q, score, vec_id, square): every task's best rows of its shards, for the queries that
    visit them in this step: 0 the first shard of their route, 1 the others, 2 all the rest."""
    dim = block.x.shape[1]
    shared = leaves.sparkSession.sparkContext.broadcast((block, balls))

    def visit(shard: int, held: list[Leaf], own: Block, balls: np.ndarray, least: np.ndarray) -> list[Found]:
        at = (own.route == shard)
        here = (at[:, 0], at[:, 1:].any(axis=1), ~at.any(axis=1))[step]
        out = []
        for lo in range(0, len(here), CHUNK):
            mine = lo + np.flatnonzero(here[lo : lo + CHUNK])
            if step and len(mine):
                mine = mine[bounds(own.x[mine], balls[shard][None])[:, 0] >= least[mine]]
            if len(mine):
                found = search_tree(own.x[mine], least[mine], held, keep)
                found.query = mine[found.query]
                out.append(found)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, balls = shared.value
        least, best = own.least, Found.none()
        held: list[Leaf] = []
        current = None
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i] for c in ("shard", "part", "nodes", "balls", "vec_ids", "x")}
                key = (row["shard"].as_py(), row["part"].as_py())
                if key != current and held:
                    best = best.best(visit(current[0], held, own, balls, least), keep)
                    least, held = best.raised(least, keep), []
                current = key
                nodes, ids = row["nodes"].as_py(), row["vec_ids"].values
                x = np.frombuffer(row["x"].as_py(), np.float64).reshape(len(ids), dim)
                held.append(Leaf(
                    nodes, np.frombuffer(row["balls"].as_py(), np.float64).reshape(len(nodes), dim + 1), x,
                    ids.fill_null(0).to_numpy(zero_copy_only=False),
                    ids.is_null().to_numpy(zero_copy_only=False), squares(x),
                ))
        if held:
            best = best.best(visit(current[0], held, own, balls, least), keep)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.number[best.query]), pa.array(best.score),
             pa.array(best.vec_id, pa.int64(), mask=best.missing), pa.array(best.square)],
            names=["q", "score", "vec_id", "square"],
        )

    return leaves.mapInArrow(run, "q long, score long, vec_id long, square long")


def first_of(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def index(spark: SparkSession, rows: DataFrame, dim: int, n: int, folder: str) -> tuple[DataFrame, np.ndarray]:
    """The written leaves of all shards, and the shards' balls."""
    shards = min(MOST_SHARDS, -(-n // SHARD_ROWS))
    parts = -(-n // (shards * SHARD_ROWS))
    mixed = F.pmod(F.xxhash64("x", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(mixed * n < SAMPLE).select("x").limit(2 * SAMPLE)
    points = unpack(sample.toArrow()["x"].combine_chunks(), dim) if shards > 1 else np.zeros((0, dim))
    tree = fit_shards(points, shards) if len(points) else Split(shard=0)
    dealt = shard_of(tree, points)
    shards = int(dealt.max(initial=0)) + 1
    centres = np.stack([
        points[dealt == s].mean(axis=0) if (dealt == s).any() else np.zeros(dim) for s in range(shards)
    ])
    shared = spark.sparkContext.broadcast((tree, centres))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, centres = shared.value
        for batch in batches:
            x = unpack(batch.column("x"), dim)
            shard = shard_of(tree, x)
            yield batch.append_column("shard", pa.array(shard)).append_column(
                "reach", pa.array(reach(x, centres[shard]))
            )

    dealt = rows.select("vec_id", "x").mapInArrow(deal, "vec_id long, x binary, shard int, reach double")
    part = F.pmod(F.xxhash64("vec_id", "x"), F.lit(parts)).cast("int")
    dealt = save(dealt.withColumn("part", part), f"{folder}/dealt")
    radii = np.zeros(shards)
    for shard, radius in dealt.groupBy("shard").agg(F.max("reach")).collect():  # MOST_SHARDS rows at most
        radii[shard] = radius
    leaves = save(
        dealt.select("shard", "part", "vec_id", "x").groupBy("shard", "part").applyInArrow(plant(dim), LEAF),
        f"{folder}/leaves",
    )
    return leaves, np.column_stack([centres, radii])


def routed(queries: DataFrame, dim: int, balls: np.ndarray) -> DataFrame:
    """The queries with a number, their shards of the first two waves and their squares."""
    shared = queries.sparkSession.sparkContext.broadcast(balls)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = shared.value
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                rows = batch.slice(at, CHUNK)
                x = unpack(rows.column("x"), dim)
                first = np.argsort(-bounds(x, balls), axis=1, kind="stable")[:, : 1 + SECOND].astype(np.int32)
                yield rows.append_column("route", pa.array(list(first), pa.list_(pa.int32()))).append_column(
                    "square", pa.array(squares(x))
                )

    numbered = queries.mapInArrow(run, "x binary, route array<int>, square long")
    return numbered.withColumn("q", F.monotonically_increasing_id())


def blocks(queries: DataFrame, dim: int) -> Iterator[Block]:
    """The queries in blocks of bounded bytes; one at a time is on the driver."""
    most = max(1, BLOCK_BYTES // (8 * max(dim, 1)))
    held = []

    def block() -> Block:
        x = unpack(pa.array([bytes(r["x"]) for r in held], pa.binary()), dim)
        route = np.array([r["route"] for r in held], np.int32)
        least = np.full(len(held), np.iinfo(np.int64).min)
        return Block(np.array([r["q"] for r in held], np.int64), x, route, least)

    for row in queries.select("q", "x", "route").toLocalIterator():
        held.append(row)
        if len(held) == most:
            yield block()
            held = []
    if held:
        yield block()


def search_one_length(spark: SparkSession, rows: DataFrame, queries: DataFrame, dim: int, n: int,
                      folder: str, keep: int) -> DataFrame:
    """(x, square, best): the best ``keep`` rows of every distinct query vector."""
    leaves, balls = index(spark, rows, dim, n, folder)
    asked = save(routed(queries.select("x"), dim, balls), f"{folder}/queries")
    steps = 1 if len(balls) == 1 else 2 if len(balls) <= 1 + SECOND else 3
    done = []
    for place, block in enumerate(blocks(asked, dim)):
        found = None
        for step in range(steps):
            new = wave(leaves, block, balls, step, keep)
            if found is not None:
                new = new.unionByName(found.drop("rank"))
            found = save(first_of(new, keep), f"{folder}/found-{place}-{step}")
            if step + 1 < steps:
                at = {q: i for i, q in enumerate(block.number.tolist())}
                for q, score in found.filter(F.col("rank") == keep).select("q", "score").collect():
                    block.least[at[q]] = score  # a row per query of the block
        done.append(f"{folder}/found-{place}-{steps - 1}")
    found = spark.read.parquet(*done)
    best = found.groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", "square"))).alias("best")
    )  # at most ``keep`` rows each
    return asked.select("q", "x", "square").join(best, "q").select(F.lit(dim).alias("dim"), "x", "square", "best")


def nearest(spark: SparkSession, vectors: DataFrame, k: int = 5, every: int = 50, id_column: str = "vec_id",
            column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of each row whose id ``every`` divides."""
    folder = workspace(spark, "vectors")
    rows = save(scaled(vectors, id_column, column), f"{folder}/rows")
    # Spark cuts to k + 1 rows before the shuffle too, so a hot vector is a few rows of each task.
    copies = Window.partitionBy("dim", "x").orderBy(F.asc_nulls_last("vec_id"))
    kept = save(
        rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy"),
        f"{folder}/candidates",
    )
    asking = rows.filter(F.col("vec_id") % every == 0)
    queries = save(asking.select("dim", "x").distinct(), f"{folder}/asking")
    sizes = {dim: n for dim, n in kept.groupBy("dim").agg(F.count("*")).collect()}
    parts = [
        search_one_length(spark, kept.filter(F.col("dim") == dim), queries.filter(F.col("dim") == dim), dim,
                          sizes[dim], f"{folder}/{dim}", k + 1)
        for dim, in queries.select("dim").distinct().collect()
    ]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    answered = asking.select("dim", "x", F.col("vec_id").alias("query_id")).join(best, ["dim", "x"])
    # Equal vectors are those whose product is that of each with itself.
    own = F.array_position(F.transform("best", lambda b: (
        b["vec_id"].eqNullSafe(F.col("query_id")) & (b["score"] == F.col("square")) & (b["square"] == F.col("square"))
    )), True)
    others = answered.select("query_id", "best", own.alias("own")).select(
        "query_id", F.slice(F.filter("best", lambda b, i: i + 1 != F.col("own")), 1, k).alias("best")
    )
    return others.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", "b.score"
    )
