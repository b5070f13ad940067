"""Client segments: features per client, k-means with restarts, elbow and silhouette."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.expressions import half_even, ratio
from tillmark.operators.features import standardize
from tillmark.operators.sampling import DEFAULT_SEED, hash_split, row_hash, sample_rows
from tillmark.session import materialize
from tillmark.sources.csv import union_all

FEATURES = ("total_monto", "total_unidades", "n_transacciones", "descuento_prom")
RESTARTS = 10
MAX_ITERATIONS = 300
#: A model whose centres move by less, squared and summed, takes one more pass for its inertia and ends.
TOLERANCE = 1e-4
SILHOUETTE_SAMPLE = 10_000
SILHOUETTE_BLOCK = 10_000
ELBOW_RANGE = tuple(range(2, 9))


def client_features(df: DataFrame) -> DataFrame:
    """One row per client: total amount and units, distinct receipts, mean discount."""
    return (
        df.where(F.col("codigo_cliente").isNotNull())
        .groupBy("codigo_cliente")
        .agg(
            F.sum("monto_aplicado").alias("total_monto"),
            F.sum("unidades").alias("total_unidades"),
            F.count_distinct("boleta").alias("n_transacciones"),
            F.avg("porcentaje_descuento").alias("descuento_prom"),
        )
        .dropna()
    )


def scaled_clients(clients: DataFrame, seed: int = DEFAULT_SEED, ratio_train: float = 0.7) -> DataFrame:
    """Clients with standardised ``z_`` columns and ``is_train``."""
    renamed = clients.withColumns({f"z_{c}": F.col(c).cast("double") for c in FEATURES})
    scaled = standardize(renamed, [f"z_{c}" for c in FEATURES])
    return hash_split(scaled, ["codigo_cliente"], seed, ratio_train)


@dataclass
class Segments:
    """Centres in standardised feature space, and their within-cluster sum of squares on train."""

    k: int
    centres: np.ndarray
    inertia: float


#: Draws are remainders by this prime; a product of two fits a long.
PRIME = 2_147_483_647


def draw_parameters(k: int, restart: int, step: int, seed: int = DEFAULT_SEED) -> tuple[int, int]:
    """Factor and shift of one draw's linear hash ``(key % PRIME * factor + shift) % PRIME``."""
    number = (k * 10_007 + restart * 101 + step + 1) * 1_000 + seed % 1_000
    return number * 1_103_515_245 % (PRIME - 1) + 1, number * 69_069 % PRIME


def _uniform(keys: np.ndarray, factor: int, shift: int) -> np.ndarray:
    """Numbers of (0, 1) from whole keys, the same on any engine with 64-bit integers."""
    return ((keys % PRIME * factor + shift) % PRIME + 0.5) / PRIME


def _draws(models: dict[int, tuple[int, int, np.ndarray]], columns: Sequence[str]):
    """Table function: per model the client of a task with the smallest -ln(u) / d2, d2 its squared distance to the model's centres.

    The smallest of all tasks is a draw in proportion to d2. ``models`` has the draw's factor and shift and the centres so far.
    """
    names = list(columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, keys = batch[names].to_numpy(float), batch["_key"].to_numpy()
            best = []
            for model, (factor, shift, centres) in models.items():
                squared = np.ones(len(x))
                if len(centres):
                    squared = np.min([((x - c) ** 2).sum(axis=1) for c in centres], axis=0)
                with np.errstate(divide="ignore"):
                    score = -np.log(_uniform(keys, factor, shift)) / squared
                row = np.lexsort((keys, score))[0]
                best.append((model, score[row], keys[row], *x[row]))
            if len(batch):
                yield pd.DataFrame(best, columns=["model", "score", "_key", *names])

    return run


def _starting_centres(rows: DataFrame, models: dict[int, tuple[int, int]], columns: Sequence[str], seed: int) -> dict[int, np.ndarray]:
    """Spread-out starts from all rows: each next centre is drawn in proportion to its squared distance.

    One pass a step draws the next centre of all models (k and restart) that still need one. Clients that
    share a place with a centre are drawn last.
    """
    keyed = rows.select(row_hash(["codigo_cliente"], seed).alias("_key"), *columns)
    schema = ", ".join(["model int", "score double", "_key bigint", *[f"{c} double" for c in columns]])
    centres = {i: np.empty((0, len(columns))) for i in models}
    for step in range(max(k for k, _ in models.values())):
        waiting = {i: (*draw_parameters(k, restart, step, seed), centres[i]) for i, (k, restart) in models.items() if k > step}
        drawn = keyed.mapInPandas(_draws(waiting, columns), schema).groupBy("model")
        found = drawn.agg(F.min_by(F.struct(*columns), F.struct("score", "_key")).alias("centre")).collect()
        for r in found:
            centres[r["model"]] = np.vstack([centres[r["model"]], [r["centre"][c] for c in columns]])
    return centres


def _cluster_sums(models: dict[int, np.ndarray], columns: Sequence[str]):
    """Table function: per model and cluster, the row count, feature sums and squared distance."""
    names = list(columns)
    stacked = np.concatenate(list(models.values()))
    lengths = (stacked**2).sum(axis=1)
    edges = np.cumsum([0, *[len(c) for c in models.values()]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((len(stacked), len(names) + 2))
        for batch in batches:
            x = batch[names].to_numpy(float)
            squares = (x**2).sum(axis=1)
            distance = lengths - 2.0 * x @ stacked.T  # less the row's own square, the same for all
            for start, end in zip(edges[:-1], edges[1:]):
                nearest = distance[:, start:end].argmin(axis=1)
                closest = np.maximum(distance[np.arange(len(x)), start + nearest] + squares, 0.0)
                for column, weights in enumerate([None, *x.T, closest]):
                    totals[start:end, column] += np.bincount(nearest, weights, minlength=end - start)
        frame = pd.DataFrame(totals, columns=["n", *names, "cost"])
        numbers = np.repeat(list(models), np.diff(edges))
        yield frame.assign(model=numbers, cluster=np.concatenate([np.arange(len(c)) for c in models.values()]))

    return run


def fit_segments(
    train: DataFrame, ks: Iterable[int], restarts: int = RESTARTS, seed: int = DEFAULT_SEED, tolerance: float = TOLERANCE
) -> list[Segments]:
    """K-means: for each k the restart with the lowest inertia, its centres in order of their coordinates.

    All restarts of all k advance together. One pass over the clients per iteration sums every
    model's clusters inside the tasks, and only models x clusters rows reach the driver. Starts
    and passes use every client.
    """
    columns = [f"z_{c}" for c in FEATURES]
    ks = list(dict.fromkeys(ks))
    owner = [k for k in ks for _ in range(restarts)]
    rows = train.select("codigo_cliente", *columns).persist()
    models = _starting_centres(rows, {i: (k, i % restarts) for i, k in enumerate(owner)}, columns, seed)
    finished: dict[int, Segments] = {}
    settled: set[int] = set()
    schema = ", ".join(["n double", *[f"{c} double" for c in columns], "cost double", "model int", "cluster int"])
    try:
        for iteration in range(MAX_ITERATIONS + 1):
            partial = rows.select(*columns).mapInPandas(_cluster_sums(models, columns), schema)
            sums = partial.groupBy("model", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", *columns, "cost")]).toPandas()
            for i, table in sums.groupby("model"):
                if i in settled or iteration == MAX_ITERATIONS:
                    centres = models.pop(i)
                    finished[i] = Segments(owner[i], centres[np.lexsort(centres.T[::-1])], float(table["cost"].sum()))
                    continue
                table = table.set_index("cluster").sort_index()
                size = table["n"].to_numpy()[:, None]
                moved = np.where(size > 0, table[columns].to_numpy() / np.maximum(size, 1), models[i])
                if ((moved - models[i]) ** 2).sum() <= tolerance:
                    settled.add(i)
                models[i] = moved
            if not models:
                break
    finally:
        rows.unpersist()
    return [min((s for s in finished.values() if s.k == k), key=lambda s: s.inertia) for k in ks]


def has_enough_clients(clients: DataFrame, k: int) -> bool:
    return clients.limit(2 * k).count() >= 2 * k


def assign(segments: Segments, clients: DataFrame) -> DataFrame:
    """Add ``cluster``, the number of the nearest centre."""
    squares = []
    for i, centre in enumerate(segments.centres.tolist()):
        parts = [(F.col(f"z_{c}") - value) ** 2 for c, value in zip(FEATURES, centre)]
        squares.append(F.struct(sum(parts[1:], parts[0]).alias("distance"), F.lit(i).alias("cluster")))
    nearest = F.least(*squares) if len(squares) > 1 else squares[0]
    return clients.withColumn("cluster", nearest["cluster"])


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_clients")).orderBy(F.desc("n_clients"), "cluster")


def cluster_profile(labelled: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Mean of the unscaled features per cluster, one decimal."""
    return labelled.groupBy("cluster").agg(*[half_even(F.avg(c), 1).alias(c) for c in columns])


def elbow_table(spark: SparkSession, fits: Sequence[Segments]) -> DataFrame:
    """Inertia per k."""
    return spark.createDataFrame([(s.k, s.inertia) for s in fits], "k int, inertia double")


def _distance_sums(shared, clusters: Sequence[int], columns: Sequence[str], kept: Sequence[str]):
    """Table function: per row its summed distance to the shared rows of each cluster."""
    names = list(columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        others, labels = shared.value
        member = (labels[:, None] == np.array(clusters)[None, :]).astype(float)
        for batch in batches:
            for start in range(0, len(batch), 500):
                block = batch.iloc[start : start + 500]
                x = block[names].to_numpy(float)
                distance = np.sqrt(((x[:, None, :] - others[None, :, :]) ** 2).sum(axis=2))
                yield block[list(kept)].assign(**{f"_to_{c}": total for c, total in zip(clusters, (distance @ member).T)})

    return run


def _widths(rows: DataFrame, inside: Column, outside: Sequence[Column], own_size: Column) -> DataFrame:
    """Add ``silhouette``: 0 for a client that is alone or has no other cluster to compare with."""
    between = F.least(*outside) if len(outside) > 1 else outside[0] if outside else F.lit(None).cast("double")
    width = F.coalesce(ratio(between - inside, F.greatest(between, inside)), F.lit(0.0))
    return rows.withColumn("silhouette", F.when(own_size > 1, width).otherwise(0.0))


def silhouette_points(labelled: DataFrame, columns: Sequence[str], keys: Sequence[str], n: int = SILHOUETTE_SAMPLE, seed: int = DEFAULT_SEED) -> DataFrame:
    """Euclidean silhouette of each client in a seeded sample of at most ``n``; ``keys`` tell clients apart.

    Every sampled client is measured against all of them, block by block: a block of about ``SILHOUETTE_BLOCK``
    short rows is shared with the tasks, and each adds up its distances. Work grows with the square of ``n``.
    """
    spark = labelled.sparkSession
    sample = materialize(sample_rows(labelled, n, keys, seed).select(*keys, "cluster", *columns), "silhouette-sample")
    sizes = {r["cluster"]: r["n"] for r in sample.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a cluster
    clusters, blocks = sorted(sizes), max(1, -(-sum(sizes.values()) // SILHOUETTE_BLOCK))
    kept = [*keys, "cluster"]
    kinds = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in sample.schema if f.name in kept], *[f"`_to_{c}` double" for c in clusters]])
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks))
    spread_out = sample.repartition(spark.sparkContext.defaultParallelism)
    pieces = []
    for b in range(blocks):
        others = sample.where(block == b).toPandas()
        shared = spark.sparkContext.broadcast((others[list(columns)].to_numpy(float), others["cluster"].to_numpy(int)))
        pieces.append(spread_out.mapInPandas(_distance_sums(shared, clusters, columns, kept), kinds))
    totals = union_all(pieces).groupBy(*kept).agg(*[F.sum(f"_to_{c}").alias(f"_to_{c}") for c in clusters])
    if not clusters:
        return totals.withColumn("silhouette", F.lit(None).cast("double"))
    own = [F.when(F.col("cluster") == c, F.col(f"_to_{c}")) for c in clusters]
    size = F.coalesce(*[F.when(F.col("cluster") == c, F.lit(sizes[c])) for c in clusters])
    outside = [F.when(F.col("cluster") != c, F.col(f"_to_{c}") / sizes[c]) for c in clusters]
    return _widths(totals, ratio(F.coalesce(*own), size - 1), outside, size).select(*kept, "silhouette")


def silhouette(labelled: DataFrame, columns: Sequence[str], keys: Sequence[str], n: int = SILHOUETTE_SAMPLE, seed: int = DEFAULT_SEED) -> DataFrame:
    points = silhouette_points(labelled, columns, keys, n, seed)
    return points.agg(F.count(F.lit(1)).alias("n_sample"), F.avg("silhouette").alias("silhouette"))


def squared_silhouette_points(labelled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``silhouette`` by squared distances to every client, from sums per cluster and thus in linear time.

    The mean squared distance to a cluster is the client's own square, less twice its product with the
    cluster's mean, plus the cluster's mean square. Clusters, a row each, are looked up on the driver.
    """
    square = sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))
    of_clusters = labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(square).alias("square"), *[F.avg(c).alias(c) for c in columns])
    inside, outside, size = F.lit(None).cast("double"), [], F.lit(None).cast("bigint")
    for r in of_clusters.orderBy("cluster").collect():
        product = sum((F.col(c) * r[c] for c in columns[1:]), F.col(columns[0]) * r[columns[0]])
        distance = F.greatest(F.lit(0.0), square - 2 * product + r["square"])
        mine = F.col("cluster") == r["cluster"]
        inside = F.when(mine, distance * r["n"] / max(r["n"] - 1, 1)).otherwise(inside)
        size = F.when(mine, r["n"]).otherwise(size)
        outside.append(F.when(~mine, distance))
    return _widths(labelled, inside, outside, size)


def full_silhouette(labelled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of clients and mean squared-distance silhouette: a row for all clients, without ``cluster``, and one per cluster."""
    points = squared_silhouette_points(labelled, columns)
    found = points.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_clients"), F.avg("silhouette").alias("silhouette"))
    whole = points.agg(F.lit(None).cast("int").alias("cluster"), F.count(F.lit(1)).alias("n_clients"), F.avg("silhouette").alias("silhouette"))
    return whole.unionByName(found)
