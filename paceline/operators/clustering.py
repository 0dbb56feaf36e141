"""K-means for all groups at once, and the meaning of its clusters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import inf

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.operators.keyed import attach_stats
from paceline.operators.stats import clean_number
from paceline.session import discard, stage

CLUSTERS = 3
NOISE = -1

# Meaning of the renumbered labels.
SEMANTICS = {0: "push", 1: "base", 2: "degraded"}


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def vector(features: Sequence[str]) -> Column:
    return F.array(*[clean_number(c) for c in features])


def complete(features: Sequence[str]) -> Column:
    """True for rows without a missing feature; only they take part in clustering."""
    out = F.lit(True)
    for c in features:
        out = out & clean_number(c).isNotNull()
    return out


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def _with(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a per-group table; without keys it is one row and is broadcast."""
    return df.join(table, list(keys), how) if keys else df.join(F.broadcast(table))


def _nearest(features: Column, centroids: Column) -> Column:
    """struct(squared distance, label) of the nearest centroid, the lowest label on a tie."""
    return F.array_min(F.transform(centroids, lambda c, j: F.struct(
        squared_distance(c, features).alias("d"), j.cast("int").alias("label"))))


#: Rows of a group that one task clusters by itself, and of a share of a larger group.
GROUP_ROWS, SHARE_ROWS = 100_000, 8192
#: Bytes of sums that the driver reads at a time in a round over shares.
SUMS_BYTES = 32 << 20
#: Features from which distances and sums come from matrix products.
_PRODUCT_DIMS = 8


def _matrix(cell) -> np.ndarray:
    return np.stack(list(cell)).astype(float)


def _labels(f: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each row, the lowest on a tie.

    With many features it comes from a matrix product; rows that this leaves in doubt, close to two centroids, are compared by the differences.
    """
    if f.shape[1] >= _PRODUCT_DIMS and len(c) > 1:
        middle = c.mean(0)
        off = c - middle
        with np.errstate(over="ignore", invalid="ignore"):
            own, mid = (off * off).sum(1), off @ middle
            score = f @ (-2 * off.T)
            score += own + 2 * mid
            label = score.argmin(1)
            least = np.partition(score, 1, axis=1)
            noise = np.sqrt(np.einsum("ij,ij->i", f, f)) * np.sqrt(own.max()) + own.max() + np.abs(mid).max()
            doubt = ~(least[:, 1] - least[:, 0] > 1e-14 * f.shape[1] * noise)
        if doubt.any():
            label[doubt] = _compared(f[doubt], c)
        return label
    return _compared(f, c)


def _compared(f: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = np.zeros((len(c), len(f)))
    for i in range(f.shape[1]):
        d += (f[:, i] - c[:, i, None]) ** 2
    return d.argmin(0)


def _sums(f: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows per centroid, and the sums of their features."""
    label = _labels(f, c)
    n = np.bincount(label, minlength=len(c))
    if f.shape[1] >= _PRODUCT_DIMS:
        with np.errstate(invalid="ignore", over="ignore"):
            sums = (label == np.arange(len(c))[:, None]).astype(float) @ f
        if np.isfinite(sums).all():
            return n, sums
    return n, np.stack([np.bincount(label, f[:, i], len(c)) for i in range(f.shape[1])], 1)


def _moved(c: np.ndarray, n: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, float]:
    """The next centroids, and how far (squared) the farthest moved. One that lost all its rows stays where it was."""
    new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return new, float(((new - c) ** 2).sum(1).max())


def _settled(points: DataFrame, cents: DataFrame, keys: list[str], dims: int, tol: float,
             group_rows: int | None = None, share_rows: int | None = None) -> DataFrame:
    """(keys, _model, _c): iterate until no centroid moves by more than ``tol`` deviations of its group's features.

    ``cents`` has the keys, ``_n``, the rows of the group, ``_m``, its models as (id, c: centroids), and
    ``_var``, the mean variance of the features. Every iteration lowers the inertia of a model or is its
    last, so there is no number of them to choose. A group of at most ``group_rows`` rows is packed
    once and iterated in one task. A larger one is cut into shares, which are packed once, too;
    an iteration is one job that returns their sums, and settled models leave the loop.
    """
    small, share = group_rows or GROUP_ROWS, share_rows or SHARE_ROWS
    gk = keys or ["_all"]
    if not keys:
        cents = cents.withColumn("_all", F.lit(0))
    numbered = points.withColumn("_i", F.monotonically_increasing_id())
    sized = numbered.join(cents.select(*keys, "_n"), keys) if keys else numbered.crossJoin(F.broadcast(cents.select("_all", "_n")))
    shares = F.when(F.col("_n") > small, F.ceil(F.col("_n") / share)).otherwise(1).cast("long")
    # Sorted, so that the last digits of sums do not depend on how rows arrive.
    packed = sized.groupBy(*gk, "_n", F.pmod("_i", shares).alias("_share")).agg(F.sort_array(F.collect_list("_f")).alias("_p"))
    key_fields = [T.StructField(k, cents.schema[k].dataType) for k in gk]
    matrix = T.ArrayType(T.ArrayType(T.DoubleType()))
    schema = T.StructType([*key_fields, T.StructField("_model", T.LongType()), T.StructField("_c", matrix)])

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for *key, var, models, cell in zip(*[pdf[k] for k in gk], pdf["_var"], pdf["_m"], pdf["_p"]):
                f = _matrix(cell)
                for m in models:
                    c, shift = _matrix(m["c"]), inf
                    while shift > var * tol * tol:
                        c, shift = _moved(c, *_sums(f, c))
                    out.append((*key, m["id"], c.tolist()))
            yield pd.DataFrame(out, columns=schema.names)

    fitted = packed.where(F.col("_n") <= small).select(*gk, "_p").join(cents.select(*gk, "_var", "_m"), gk).mapInPandas(own, schema)
    done = stage(fitted, "centroids")
    large = stage(cents.where(F.col("_n") > small).select(*gk, F.monotonically_increasing_id().alias("_g"), "_n", "_var", "_m"), "centroids")
    if not large.isEmpty():
        def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pd.DataFrame({"_g": pdf["_g"], "_p": [_matrix(cell).tobytes() for cell in pdf["_p"]]})

        shares = packed.where(F.col("_n") > small).drop("_n").join(large.select(*gk, "_g"), gk).select("_g", "_p")
        found = _rounds(stage(shares.mapInPandas(flat, "_g long, _p binary"), "shares"), large, dims, tol, share)
        done = done.unionByName(large.select(*gk, "_g").join(found, "_g").select(*schema.names))
    return done.select(*keys, "_model", "_c")


def _rounds(shares: DataFrame, large: DataFrame, dims: int, tol: float, share: int) -> DataFrame:
    """(_g, _model, _c): the settled models of groups that are spread over shares, one round after the other.

    The driver holds the centroids of the ``large`` groups, of which there are few, and reads their sums, of so many models at a time
    that these stay below ``SUMS_BYTES``.
    """
    models, heavy = {}, {}
    for g, n, var, m in large.select("_g", "_n", "_var", "_m").collect():
        for x in m:
            models[g, x["id"]] = var, _matrix(x["c"])
            heavy[g, x["id"]] = (n // share + 1) * len(x["c"]) * (dims + 1) * 8
    done = []
    while models:
        parts, room = [], 0
        for name, (_, c) in models.items():
            if room < heavy[name]:
                parts.append({})
                room = SUMS_BYTES
            parts[-1].setdefault(name[0], []).append((name[1], c))
            room -= heavy[name]
        total: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for part in parts:
            for r in shares.mapInPandas(_adding(part, dims), "g long, model long, n array<long>, s binary").collect():
                _add(total, (r.g, r.model), np.array(r.n), np.frombuffer(r.s).reshape(-1, dims))
        left = {}
        for name, (var, c) in models.items():
            new, shift = _moved(c, *total[name])
            if shift > var * tol * tol:
                left[name] = var, new
            else:
                done.append((*name, new.tolist()))
        models = left
    found = stage(shares.sparkSession.createDataFrame(done, "_g long, _model long, _c array<array<double>>"), "centroids")
    discard(shares)
    return found


def _add(total: dict, name: tuple, n: np.ndarray, s: np.ndarray) -> None:
    was = total.get(name)
    total[name] = (n, s) if was is None else (was[0] + n, was[1] + s)


def _adding(asked: dict, dims: int):
    """The sums of the shares of a task for the models ``asked`` for, by group."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict = {}
        for pdf in batches:
            for g, cell in zip(pdf["_g"], pdf["_p"]):
                f = np.frombuffer(cell).reshape(-1, dims)
                for i, c in asked.get(g, ()):
                    _add(total, (g, i), *_sums(f, c))
        if total:
            yield pd.DataFrame([(g, i, n, s.tobytes()) for (g, i), (n, s) in total.items()], columns=["g", "model", "n", "s"])
    return sums


def _moments(points: DataFrame, keys: list[str], dims: int) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i in range(dims):
        aggs += [F.avg(F.col("_f")[i]).alias(f"_m{i}"), F.stddev_pop(F.col("_f")[i]).alias(f"_s{i}")]
    out = points.groupBy(*keys).agg(*aggs) if keys else points.agg(*aggs)
    variance = reduce(Column.__add__, [F.col(f"_s{i}") * F.col(f"_s{i}") for i in range(dims)]) / dims
    return out.withColumn("_var", variance)


def kmeans_centroids(points: DataFrame, keys: Sequence[str], dims: int, k: int = CLUSTERS, tol: float = 1e-9) -> DataFrame:
    """(keys, _c): k centroids per group with at least k rows, by Lloyd's iteration.

    ``points`` holds the keys and ``_f``, an array of ``dims`` numbers. Seeds lie on the diagonal
    through the group mean, one population deviation apart, so results do not depend on chance or
    on partitioning. A group of up to ``GROUP_ROWS`` rows is iterated in one task; of a larger one, each
    iteration is one job over its shares. ``tol`` counts in deviations of the features, whatever their size.
    """
    return _diagonal_models(points, list(keys), dims, (k,), tol).drop("k")


def _diagonal_models(points: DataFrame, keys: list[str], dims: int, ks: Sequence[int], tol: float) -> DataFrame:
    """(keys, k, _c): the centroids of :func:`kmeans_centroids` for every k, found in the same iterations."""
    def model(k: int) -> Column:
        seed = F.array(*[F.array(*[F.col(f"_m{i}") + F.lit(j - (k - 1) / 2) * F.col(f"_s{i}") for i in range(dims)]) for j in range(k)])
        return F.when(F.col("_n") >= k, F.struct(F.lit(k).alias("id"), seed.alias("c")))

    models = F.filter(F.array(*[model(k) for k in ks]), lambda m: m.isNotNull())
    cents = stage(_moments(points, keys, dims).where(F.col("_n") >= min(ks)).select(*keys, "_n", "_var", models.alias("_m")), "centroids")
    return _settled(points, cents, keys, dims, tol).select(*keys, F.col("_model").cast("int").alias("k"), "_c")


def kmeans_each_k(df: DataFrame, keys: Sequence[str], features: Sequence[str], ks: Sequence[int], tol: float = 1e-9) -> DataFrame:
    """``df`` with the labels of :func:`kmeans` once for every k of ``ks`` that its group has rows for, told by column ``k``; clustered rows only."""
    require(df, features)
    keys = list(keys)
    rows = df.where(complete(features))
    points = stage(rows.select(*keys, vector(features).alias("_f")), "points")
    cents = _diagonal_models(points, keys, len(features), ks, tol)
    out = (rows.join(cents, keys) if keys else rows.join(F.broadcast(cents))).withColumn("_near", _nearest(vector(features), F.col("_c")))
    return out.select(*df.columns, "k", F.col("_near.label").alias("cluster_label"), F.sqrt("_near.d").alias("cluster_centroid_distance"))


def kmeans(df: DataFrame, keys: Sequence[str], features: Sequence[str], k: int = CLUSTERS, tol: float = 1e-9) -> DataFrame:
    """Append cluster_label and cluster_centroid_distance; groups below k rows get -1 and NULL.

    So do rows with a missing feature; impute before to have them clustered.
    """
    require(df, features)
    points = stage(df.where(complete(features)).select(*keys, vector(features).alias("_f")), "points")
    cents = kmeans_centroids(points, keys, len(features), k, tol)
    return _labelled(df, cents, keys, features)


def _labelled(df: DataFrame, cents: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    near = F.when(complete(features), _nearest(vector(features), F.col("_c")))
    out = _with(df, cents, keys, "left").withColumn("_near", near)
    return out.select(*df.columns, F.coalesce(F.col("_near.label"), F.lit(NOISE)).alias("cluster_label"),
                      F.sqrt("_near.d").alias("cluster_centroid_distance"))


def kmeans_models(df: DataFrame, keys: Sequence[str], row_id: str, features: Sequence[str], ks: Sequence[int] = (CLUSTERS,),
                  starts: int = 10, tol: float = 1e-9) -> DataFrame:
    """(keys, k, inertia, _c): for each group and each of ``ks`` the best of ``starts`` K-means models.

    A start takes its seeds from the rows: the first by a hash of ``row_id`` and the start, each further
    one the row that is hash-drawn with a chance in proportion to its squared distance from the seeds
    so far (Arthur and Vassilvitskii 2007), by the smallest exponential of rate d. All starts and all ks run in the same
    iterations; settled ones leave. Equal inertia goes to the earlier start. Groups with fewer rows
    than k have no model of that k.
    """
    require(df, features)
    keys, dims, most = list(keys), len(features), max(ks)
    points = stage(df.where(complete(features)).select(*keys, F.col(row_id).alias("_row"), vector(features).alias("_f")), "points")
    # Uniform numbers in (0, 1) that depend on row, start and draw only.
    def uniform(start: Column, draw: int) -> Column:
        digest = F.md5(F.concat_ws(":", F.col("_row").cast("string"), start.cast("string"), F.lit(str(draw))))
        return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))

    numbers = F.array(*[F.lit(s) for s in range(starts)])
    seeds = None
    for draw in range(most):
        if seeds is None:
            rows = points.select(*keys, "_row", "_f", F.explode(numbers).alias("_start"), F.array().cast("array<array<double>>").alias("_c"))
            chance = F.lit(1.0)
        else:
            held = F.array(*[F.struct(F.lit(s).alias("s")) for s in range(starts)])
            rows = (_with(points, seeds, keys).withColumn("_x", F.explode(held)).withColumn("_start", F.col("_x.s"))
                    .withColumn("_c", F.try_element_at("_all", F.col("_start"))).select(*keys, "_row", "_f", "_start", "_c"))
            chance = F.array_min(F.transform("_c", lambda c: squared_distance(c, F.col("_f"))))
        wait = F.when(chance > 0, -F.log(uniform(F.col("_start"), draw)) / chance).otherwise(F.lit(float("inf")))
        best = rows.groupBy(*keys, "_start").agg(F.min_by(F.struct("_f", "_c"), F.struct(wait, F.col("_row"))).alias("_b"))
        grown = F.struct("_start", F.concat("_b._c", F.array("_b._f")).alias("c"))
        before, entries = seeds, F.map_from_entries(F.collect_list(grown)).alias("_all")
        seeds = stage(best.groupBy(*keys).agg(entries) if keys else best.agg(entries), "seeds")
        if before is not None:
            discard(before)
    moments = _moments(points, keys, dims)
    models = F.flatten(F.transform(F.map_entries("_all"), lambda e: F.array(*[F.struct(
        (e["key"] + F.lit(k * starts)).alias("id"), F.slice(e["value"], 1, k).alias("c")) for k in ks])))
    fitting = F.filter(models, lambda m: F.floor(m["id"] / starts) <= F.col("_n"))
    cents = stage(_with(moments.select(*keys, "_n", "_var"), seeds, keys).select(*keys, "_n", "_var", fitting.alias("_m")).where(F.size("_m") > 0), "centroids")
    final = stage(_settled(points, cents, keys, dims, tol), "models")
    bundle = F.collect_list(F.struct("_model", "_c")).alias("_m")
    per = _with(points, final.groupBy(*keys).agg(bundle) if keys else final.agg(bundle), keys)
    spread = per.select(*keys, F.explode(F.transform("_m", lambda m: F.struct(m["_model"].alias("model"), _nearest(F.col("_f"), m["_c"])["d"].alias("d")))).alias("x"))
    total = spread.groupBy(*keys, F.col("x.model").alias("_model")).agg(F.sum("x.d").alias("inertia"))
    rated = total.join(final, [*keys, "_model"]).withColumn("k", F.floor(F.col("_model") / starts).cast("int"))
    # Rounding noise of the sums does not decide between equal models.
    rank = F.struct(F.round("inertia", 9), F.col("_model"))
    return rated.groupBy(*keys, "k").agg(F.min_by(F.struct("inertia", "_c"), rank).alias("_b")).select(*keys, "k", "_b.inertia", "_b._c")


def kmeans_best(df: DataFrame, keys: Sequence[str], row_id: str, features: Sequence[str], k: int = CLUSTERS, starts: int = 10) -> DataFrame:
    """:func:`kmeans` with the best of several starts. Clusters are numbered by their centroids, first feature first."""
    cents = kmeans_models(df, keys, row_id, features, (k,), starts).select(*keys, F.array_sort("_c").alias("_c"))
    return _labelled(df, cents, keys, features)


def inertia(df: DataFrame, keys: Sequence[str], distance: str = "cluster_centroid_distance") -> DataFrame:
    """Sum of squared distances to the own centroid."""
    total = F.sum(F.col(distance) * F.col(distance)).alias("inertia")
    return df.groupBy(*keys).agg(total) if keys else df.agg(total)


def cluster_meaning(df: DataFrame, keys: Sequence[str], delta: str, label: str = "cluster_label") -> DataFrame:
    """(keys, label, new label, clean): base is the largest cluster, the one of smaller mean on a tie.

    Of the others the smallest mean delta is push, the largest degraded; a single other is push
    when below base, else degraded. Clean says that push < base < degraded holds. The windows run
    over the handful of clusters of a group, never over its rows.
    """
    keys = list(keys)
    d = F.col(delta)
    stats = df.groupBy(*keys, label).agg(F.count(d).alias("_size"), F.avg(d).alias("_mean"))
    group = W.partitionBy(*keys)
    base = W.partitionBy(*keys).orderBy(F.col("_size").desc(), F.abs("_mean").asc_nulls_last(), label)
    ranked = stats.withColumn("_base", F.row_number().over(base) == 1)
    other = F.when(~F.col("_base"), F.col("_mean"))
    low = W.partitionBy(*keys).orderBy(F.col("_base"), F.col("_mean").asc_nulls_last(), label)
    high = W.partitionBy(*keys).orderBy(F.col("_base"), F.col("_mean").desc_nulls_last(), F.col(label).desc())
    ranked = (ranked.withColumn("_others", F.count(F.lit(1)).over(group) - 1)
              .withColumn("_bm", F.max(F.when(F.col("_base"), F.col("_mean"))).over(group))
              .withColumn("_min", F.min(other).over(group)).withColumn("_max", F.max(other).over(group))
              .withColumn("_lo", F.row_number().over(low)).withColumn("_hi", F.row_number().over(high)))
    new = (F.when(F.col("_base"), 1)
           .when(F.col("_others") == 1, F.when(F.col("_mean") < F.col("_bm"), 0).otherwise(2))
           .when(F.col("_lo") == 1, 0).when(F.col("_hi") == 1, 2))
    clean = F.when(F.col("_others") >= 2, (F.col("_min") < F.col("_bm")) & (F.col("_max") > F.col("_bm"))).otherwise(True)
    return ranked.select(*keys, label, new.alias("_label"), clean.alias("_clean"))


def normalize_semantics(df: DataFrame, keys: Sequence[str], delta: str = "lap_delta",
                        label: str = "cluster_label") -> DataFrame:
    """Renumber labels to push 0, base 1, degraded 2 and append their names and the clean flag."""
    if delta not in df.columns or label not in df.columns:
        return df
    meaning = cluster_meaning(df, keys, delta, label)
    names = F.create_map(*[F.lit(x) for kv in SEMANTICS.items() for x in kv])
    out = df.join(meaning, [*keys, label], "left")
    return out.select(*[c for c in df.columns if c != label], F.col("_label").alias(label),
                      names[F.col("_label")].alias("cluster_semantic"), F.col("_clean").alias("cluster_semantic_clean"))


def cluster_statistics(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str = "cluster_label",
                       semantic: str = "cluster_semantic") -> DataFrame:
    """Size, share of the group in percent, mean and deviation of every feature per cluster."""
    require(df, [label])
    aggs = [F.count(F.lit(1)).alias("size")]
    if semantic in df.columns:
        aggs.append(F.min(semantic).alias(semantic))
    for c in features:
        if c in df.columns:
            aggs += [F.avg(clean_number(c)).alias(f"{c}_mean"), F.stddev_samp(clean_number(c)).alias(f"{c}_std")]
    per = df.groupBy(*keys, label).agg(*aggs)
    out = attach_stats(per, keys, [F.sum("size").alias("_total")])
    return out.select(*per.columns, F.bround(100 * F.col("size") / F.col("_total"), 2).alias("cluster_size_pct"))
