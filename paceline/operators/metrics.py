"""Quality of clusters, anomalies and change points, and the data-quality score per entity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.functions.columns import clamp
from paceline.operators.clustering import NOISE, complete, inertia, kmeans_each_k, squared_distance, vector
from paceline.operators.keyed import attach_stats
from paceline.operators.tiles import TILE_ROWS, pack, tile_pairs
from paceline.session import stage

SILHOUETTE_PASS = 0.25
DAVIES_BOULDIN_PASS = 1.5


def _grouped(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def _join(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join two per-group tables; without keys both have one row."""
    return a.join(b, list(keys), how) if keys else a.join(F.broadcast(b))


#: Features from which distances come from one matrix product, and the share of the squares below which and the squares from which they do not.
_PRODUCT_DIMS, _PRODUCT_LEAST, _PRODUCT_MOST = 8, 1e-4, 1e300


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``.

    With many features they are ``|x|^2 + |y|^2 - 2 x y`` about a common middle; those that this leaves
    with few digits, of near rows far from the middle, are taken from the differences.
    """
    dims = a.shape[1]
    if dims < _PRODUCT_DIMS:
        sq = np.zeros((len(a), len(b)))
        for i in range(dims):
            sq += (a[:, i, None] - b[None, :, i]) ** 2
        return sq
    middle = b.mean(0)
    u, v = a - middle, b - middle
    na, nb = (u * u).sum(1), (v * v).sum(1)
    largest = max(na.max(initial=0), nb.max(initial=0))
    if largest < _PRODUCT_MOST:
        sq = np.column_stack([u, na, np.ones(len(u))]) @ np.column_stack([-2 * v, np.ones(len(v)), nb]).T
        if sq.min(initial=np.inf) >= _PRODUCT_LEAST * largest:
            return sq
        unsure = sq < _PRODUCT_LEAST * np.maximum(na[:, None], nb)
    else:
        sq = np.empty((len(a), len(b)))
        unsure = np.ones(sq.shape, bool)
    x, y = np.nonzero(unsure)
    for at in range(0, len(x), 1 << 16):
        i, j = x[at:at + (1 << 16)], y[at:at + (1 << 16)]
        sq[i, j] = ((a[i] - b[j]) ** 2).sum(1)
    return sq


def silhouette(df: DataFrame, keys: Sequence[str], row_id: str, features: Sequence[str],
               label: str = "cluster_label") -> DataFrame:
    """(keys, silhouette_score): mean of (b - a) / max(a, b) over rows, Euclidean.

    A group of one tile is scored in one task. Of a larger one, a tile of rows meets a tile of its group
    and returns, per row and label, a sum of distances; pairs never leave the task. Without keys, blocks of
    tiles meet where they lie, so rows are not copied for it (:func:`_sums_of_all`).
    """
    keys, dims = list(keys), len(features)
    # Larger tiles travel less often; one of distances is 32 MB then.
    larger = {} if dims < _PRODUCT_DIMS else {"tile_rows": 2 * TILE_ROWS}
    tile_rows = larger.get("tile_rows", TILE_ROWS)
    every = df.select(*keys, F.col(row_id).alias("_id"), F.col(label).cast("int").alias("_l"), vector(features).alias("_f"))
    if not keys:
        return _mean_silhouette(_sums_of_all(every, dims, tile_rows), keys)
    every = attach_stats(every, keys, [F.count(F.lit(1)).alias("_rows")])
    pts = every.where(F.col("_rows") > tile_rows).drop("_rows")
    schema = T.StructType([*[f for f in df.schema.fields if f.name in keys],
                           T.StructField("_id", df.schema[row_id].dataType), T.StructField("_l", T.IntegerType()),
                           T.StructField("_o", T.IntegerType()), T.StructField("_d", T.DoubleType()),
                           T.StructField("_c", T.LongType())])

    def sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        sq = squared_distances(np.stack(list(left["_f"])).astype(float), np.stack(list(right["_f"])).astype(float))
        labels, inverse = np.unique(right["_l"].to_numpy(), return_inverse=True)
        member = np.eye(len(labels))[inverse]
        per = np.sqrt(sq, out=sq) @ member
        n = len(labels)
        out = {k: np.repeat(left[k].to_numpy(), n) for k in keys}
        return pd.DataFrame({**out, "_id": np.repeat(left["_id"].to_numpy(), n), "_l": np.repeat(left["_l"].to_numpy(), n),
                             "_o": np.tile(labels, len(left)), "_d": per.ravel(),
                             "_c": np.tile(member.sum(0).astype("int64"), len(left))})

    large = _mean_silhouette(tile_pairs(pts, pts, keys, "_id", sums, schema, **larger), keys)
    whole = pack(every.where(F.col("_rows") <= tile_rows).select(*keys, "_l", "_f"), keys, "")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [_group_silhouette(np.stack(list(f)).astype(float), np.asarray(own)) for f, own in zip(pdf["_f"], pdf["_l"])]
            yield pdf[keys].assign(silhouette_score=pd.Series(found, index=pdf.index, dtype=float))

    return whole.mapInPandas(score, large.schema).unionByName(large)


def _mean_silhouette(sums: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, silhouette_score) from ``sums``: for a row _id of label _l the sum _d of its distances from _c rows of label _o."""
    per = sums.groupBy(*keys, "_id", "_l", "_o").agg(F.sum("_d").alias("_d"), F.sum("_c").alias("_c"))
    own = F.col("_o") == F.col("_l")
    row = per.groupBy(*keys, "_id").agg(
        F.max(F.when(own, F.col("_c"))).alias("_n"),
        F.max(F.when(own & (F.col("_c") > 1), F.col("_d") / (F.col("_c") - 1))).alias("_a"),
        F.min(F.when(~own, F.col("_d") / F.col("_c"))).alias("_b"))
    wide = F.greatest("_a", "_b")
    s = F.when(F.col("_n") == 1, 0.0).when(wide > 0, (F.col("_b") - F.col("_a")) / wide).otherwise(0.0)
    return _grouped(row, keys, F.avg(F.when(F.col("_b").isNotNull(), s)).alias("silhouette_score"))


#: Tiles of a block, about; sums that a task holds before it passes them on; rows whose distances are worked on at a time.
_BLOCK_TILES, _HELD_SUMS, _STRIP = 32, 1 << 22, 256


def _sums_of_all(rows: DataFrame, dims: int, tile_rows: int) -> DataFrame:
    """(_id, _l, _o, _d, _c): for each of ``rows`` and each label the sum of its distances from all rows of that label, and their number.

    The rows are packed into tiles and the tiles into blocks, which are written once. Each pair of blocks is a task that reads both
    and works on their pairs of tiles, once for both sides; so nothing but sums is shuffled, once per block a row meets.
    """
    rows = rows.where(F.col("_l").isNotNull())
    tiles = max(1, -(-rows.count() // tile_rows))
    blocks = min(tiles, max(-(-tiles // _BLOCK_TILES), int(np.ceil(np.sqrt(8 * rows.sparkSession.sparkContext.defaultParallelism)))))

    @F.pandas_udf("binary")
    def flat(f: pd.Series) -> pd.Series:
        return pd.Series([np.stack(list(v)).astype(float).tobytes() for v in f])

    packed = (rows.withColumn("_t", F.pmod(F.monotonically_increasing_id(), F.lit(tiles))).repartition(blocks, "_t")
              .groupBy("_t").agg(F.collect_list(F.struct("_id", "_l", "_f")).alias("_p")).withColumn("_b", F.spark_partition_id()))
    held = stage(packed.select("_b", "_t", F.col("_p._id").alias("_id"), F.col("_p._l").alias("_l"), flat("_p._f").alias("_f")), "tiles")
    left, right = (held.select(*[F.col(c).alias(side + c) for c in ("_b", "_t", "_l", "_f")]) for side in "xy")
    b, c = F.col("x_b"), F.col("y_b")
    # Of two blocks either may be the left one; taking turns gives each as many.
    met = left.join(right, F.when(b == c, F.col("x_t") <= F.col("y_t")).otherwise((b < c) == ((b + c) % 2 == 0)))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], list] = {}

        def add(tile: int, labels: np.ndarray, counts: np.ndarray, per: np.ndarray) -> None:
            for o, n, d in zip(labels.tolist(), counts.tolist(), per):
                was = sums.setdefault((tile, o), [0, 0.0])
                was[0], was[1] = was[0] + n, was[1] + d

        def out() -> pd.DataFrame:
            return pd.DataFrame([(t, o, n, d.tobytes()) for (t, o), (n, d) in sums.items()], columns=["_t", "_o", "_c", "_d"])

        for pdf in batches:
            for xt, xl, xf, yt, yl, yf in zip(*[pdf[n] for n in ("x_t", "x_l", "x_f", "y_t", "y_l", "y_f")]):
                x, y = (np.frombuffer(f).reshape(-1, dims) for f in (xf, yf))
                (xo, xi, xn), (yo, yi, yn) = (np.unique(np.asarray(v), return_inverse=True, return_counts=True) for v in (xl, yl))
                of_x, of_y = np.eye(len(xo))[xi], np.eye(len(yo))[yi]
                per_x, per_y = np.empty((len(x), len(yo))), np.zeros((len(xo), len(y)))
                for at in range(0, len(x), _STRIP):
                    d = squared_distances(x[at:at + _STRIP], y)
                    np.sqrt(d, out=d)
                    per_x[at:at + _STRIP] = d @ of_y
                    per_y += of_x[at:at + _STRIP].T @ d
                add(xt, yo, yn, np.ascontiguousarray(per_x.T))
                if xt != yt:
                    add(yt, xo, xn, per_y)
                if len(sums) * tile_rows > _HELD_SUMS:
                    yield out()
                    sums.clear()
        if sums:
            yield out()

    parts = met.mapInPandas(meet, "_t long, _o int, _c long, _d binary").groupBy("_t", "_o").agg(F.sum("_c").alias("_c"), F.collect_list("_d").alias("_d"))

    @F.pandas_udf("array<double>")
    def added(d: pd.Series) -> pd.Series:
        return pd.Series([np.sum([np.frombuffer(v) for v in vs], axis=0) for vs in d])

    whole = parts.select("_t", "_o", "_c", added("_d").alias("_d")).join(held.select("_t", "_id", "_l"), "_t")
    return whole.select("_o", "_c", F.inline(F.arrays_zip("_id", "_l", "_d")))


def _group_silhouette(f: np.ndarray, label: np.ndarray) -> float | None:
    """Mean silhouette of a group, from all its distances; None with fewer than two clusters."""
    labels, at = np.unique(label, return_inverse=True)
    if len(labels) < 2:
        return None
    member = np.eye(len(labels))[at]
    n, sums = member.sum(0), np.sqrt(squared_distances(f, f)) @ member
    own = sums[np.arange(len(f)), at]
    a = own / np.maximum(n[at] - 1, 1)
    b = np.where(member > 0, np.inf, sums / n).min(1)
    wide = np.maximum(a, b)
    return float(np.where((n[at] > 1) & (wide > 0), (b - a) / np.where(wide > 0, wide, 1), 0.0).mean())


def silhouette_squared(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str = "cluster_label") -> DataFrame:
    """(keys, silhouette_score): the silhouette under squared Euclidean distance, exactly and in one pass over the rows.

    The mean squared distance of x to a cluster is ``|x|^2 + mean |y|^2 - 2 x . mean y``, so a row needs
    the count, mean and mean square of each cluster of its group, which add up from partial sums.
    Features are taken from the group mean, which keeps the differences exact where they lie far out.
    A measure of its own: values differ from :func:`silhouette`, the sign and order of clear cases do not.
    """
    keys, dims = list(keys), len(features)
    f = vector(features)
    middle = _grouped(df, keys, F.array(*[F.avg(f[i]) for i in range(dims)]).alias("_o"))
    rows = _join(df.select(*keys, F.col(label).cast("int").alias("_l"), f.alias("_raw")), middle, keys, "inner")
    rows = rows.select(*keys, "_l", F.zip_with("_raw", "_o", lambda x, o: x - o).alias("_f"))
    square = F.aggregate("_f", F.lit(0.0), lambda acc, v: acc + v * v)
    per = rows.groupBy(*keys, "_l").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("_f")[i]) for i in range(dims)]).alias("c"), F.avg(square).alias("q"))
    clusters = _grouped(per, keys, F.collect_list(F.struct("_l", "n", "c", "q")).alias("_all"))

    def mean_square(c: Column) -> Column:
        product = F.aggregate(F.zip_with("_f", c["c"], lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)
        return F.greatest(F.col("_x2") + c["q"] - 2 * product, F.lit(0.0))

    met = _join(rows.withColumn("_x2", square), clusters, keys, "inner")
    met = met.withColumn("_own", F.filter("_all", lambda c: c["_l"] == F.col("_l"))[0]).withColumn("_b", F.array_min(
        F.transform(F.filter("_all", lambda c: c["_l"] != F.col("_l")), mean_square)))
    n = F.col("_own.n")
    met = met.withColumn("_a", F.when(n > 1, mean_square(F.col("_own")) * n / (n - 1)))
    wide = F.greatest("_a", "_b")
    s = F.when(n == 1, 0.0).when(wide > 0, (F.col("_b") - F.col("_a")) / wide).otherwise(0.0)
    return _grouped(met, keys, F.avg(F.when(F.col("_b").isNotNull(), s)).alias("silhouette_score"))


def cluster_quality(df: DataFrame, keys: Sequence[str], row_id: str, features: Sequence[str],
                    label: str = "cluster_label", remove_noise: bool = True, squared: bool = False) -> DataFrame:
    """Cluster counts, silhouette, Davies-Bouldin and Calinski-Harabasz per group.

    Rows with a missing feature count as noise. With fewer than two clusters the scores are NULL and ``error`` says why. All but the silhouette
    come from per-cluster sums; with ``squared`` it does, too (:func:`silhouette_squared`), and the cost no longer grows with the square of a group.
    """
    keys = list(keys)
    noise = (F.col(label) == NOISE) | ~complete(features)
    counts = _grouped(df, keys, F.count_if(noise).alias("n_noise") if remove_noise else F.lit(0).cast("long").alias("n_noise"))
    clean = df.where(~noise) if remove_noise else df
    f = vector(features)
    per = clean.groupBy(*keys, F.col(label).alias("_l")).agg(
        F.count(F.lit(1)).alias("_n"), F.array(*[F.avg(f[i]) for i in range(len(features))]).alias("_c"))
    near = clean.select(*keys, F.col(label).alias("_l"), f.alias("_f")).join(per, [*keys, "_l"])
    sq = squared_distance(F.col("_f"), F.col("_c"))
    spread = near.groupBy(*keys, "_l").agg(F.avg(F.sqrt(sq)).alias("_s"), F.sum(sq).alias("_w"))
    # A row per cluster, read four times below.
    per = stage(per.join(spread, [*keys, "_l"]), "spread")

    centre = [F.sum(F.col("_n") * F.col("_c")[i]) / F.sum("_n") for i in range(len(features))]
    overall = _grouped(per, keys, F.count(F.lit(1)).alias("n_clusters"), F.sum("_n").alias("n_samples"),
                       F.sum("_w").alias("_within"), F.array(*centre).alias("_centre"))
    between = _grouped(_join(per, overall.select(*keys, "_centre"), keys), keys,
                       F.sum(F.col("_n") * squared_distance(F.col("_c"), F.col("_centre"))).alias("_between"))
    other = per.select(*keys, F.col("_l").alias("_ol"), F.col("_c").alias("_oc"), F.col("_s").alias("_os"))
    pair = (per.join(other, keys) if keys else per.join(F.broadcast(other))).where(F.col("_l") != F.col("_ol"))
    gap = F.sqrt(squared_distance(F.col("_c"), F.col("_oc")))
    ratio = F.when(gap > 0, (F.col("_s") + F.col("_os")) / gap).otherwise(0.0)
    worst = pair.groupBy(*keys, "_l").agg(F.max(ratio).alias("_r"))
    db = _grouped(worst, keys, F.avg("_r").alias("_db"))

    out = counts
    for t in (overall.drop("_centre"), between, db,
              silhouette_squared(clean, keys, features, label) if squared else silhouette(clean, keys, row_id, features, label)):
        out = _join(out, t, keys)
    ok = F.coalesce(F.col("n_clusters") >= 2, F.lit(False))
    k, n = F.col("n_clusters"), F.col("n_samples")
    ch = F.when(F.col("_within") > 0, F.col("_between") * (n - k) / (F.col("_within") * (k - 1))).otherwise(1.0)
    return out.select(
        *keys, F.coalesce(k, F.lit(0)).alias("n_clusters"), F.coalesce(n, F.lit(0)).alias("n_samples"), "n_noise",
        F.when(ok, F.col("silhouette_score")).alias("silhouette_score"),
        F.when(ok, F.col("_db")).alias("davies_bouldin_score"), F.when(ok, ch).alias("calinski_harabasz_score"),
        F.when(~ok, F.format_string("Insufficient clusters (%d) or samples (%d)", F.coalesce(k, F.lit(0)),
                                    F.coalesce(n, F.lit(0)))).alias("error"))


def entity_quality(df: DataFrame, keys: Sequence[str], row_id: str, features: Sequence[str],
                   label: str = "cluster_label", min_rows: int = 4) -> DataFrame:
    """:func:`cluster_quality` of the groups with at least four rows and two clusters."""
    q = cluster_quality(df, keys, row_id, features, label)
    return q.where((F.col("n_samples") >= min_rows) & (F.col("n_clusters") >= 2)).select(
        *keys, "silhouette_score", "davies_bouldin_score", "calinski_harabasz_score", "n_clusters",
        F.col("n_samples").alias("n_laps"))


def quality_summary(per_entity: DataFrame, part: Sequence[str] = ()) -> DataFrame:
    """Mean, deviation and range of the entity scores."""
    s, d, c = (F.col(f"{n}_score") for n in ("silhouette", "davies_bouldin", "calinski_harabasz"))
    return _grouped(per_entity, part, F.avg(s).alias("silhouette_mean"), F.stddev_samp(s).alias("silhouette_std"),
                    F.min(s).alias("silhouette_min"), F.max(s).alias("silhouette_max"),
                    F.avg(d).alias("davies_bouldin_mean"), F.stddev_samp(d).alias("davies_bouldin_std"),
                    F.avg(c).alias("calinski_harabasz_mean"), F.count(F.lit(1)).alias("n_drivers_evaluated"))


def quality_verdict(q: DataFrame, silhouette_pass: float = SILHOUETTE_PASS,
                    davies_bouldin_pass: float = DAVIES_BOULDIN_PASS) -> DataFrame:
    """Append silhouette_pass, davies_bouldin_pass and quality: excellent, good, fair or poor."""
    s = F.coalesce(F.col("silhouette_score") >= silhouette_pass, F.lit(False))
    d = F.coalesce(F.col("davies_bouldin_score") <= davies_bouldin_pass, F.lit(False))
    verdict = (F.when(s & d, "excellent").when(s | d, "good")
               .when(F.col("silhouette_score") > 0, "fair").otherwise("poor"))
    return q.select("*", s.alias("silhouette_pass"), d.alias("davies_bouldin_pass"), verdict.alias("quality"))


def choose_k(df: DataFrame, keys: Sequence[str], row_id: str, features: Sequence[str],
             ks: Sequence[int] = (2, 3, 4, 5, 6), method: str = "silhouette") -> DataFrame:
    """(keys, k): the k of best silhouette (``silhouette``, or in one pass ``silhouette_squared``), or of the sharpest bend of the inertia (``elbow``).

    The models of all ``ks`` are found in the same iterations. Of equal ones the smallest k is taken;
    rounding noise does not decide, as where a cluster stays empty and two k give the same clusters.
    """
    keys = list(keys)
    runs = stage(kmeans_each_k(df, keys, features, ks), "models")
    each = [*keys, "k"]
    if method != "elbow":
        scored = silhouette_squared(runs, each, features) if method == "silhouette_squared" else silhouette(runs, each, row_id, features)
        every = scored.where(F.col("silhouette_score").isNotNull())
        return _grouped(every, keys, F.max_by("k", F.struct(F.round("silhouette_score", 9), -F.col("k"))).alias("k"))
    every = inertia(runs, each).where(F.col("inertia").isNotNull())
    ordered = _grouped(every, keys, F.sort_array(F.collect_list(F.struct("k", "inertia"))).alias("_i"))
    v = F.col("_i")
    bends = F.transform(F.sequence(F.lit(1), F.size(v) - 2), lambda i: F.struct(
        F.round(F.abs(F.get(v, i + 1)["inertia"] - 2 * F.get(v, i)["inertia"] + F.get(v, i - 1)["inertia"]), 6).alias("b"),
        (-F.get(v, i)["k"]).alias("nk")))
    return ordered.select(*keys, F.when(F.size(v) >= 3, -F.array_max(bends)["nk"]).otherwise(F.get(v, F.lit(0))["k"]).alias("k"))


def anomaly_summary(df: DataFrame, keys: Sequence[str], seq: str | None = None, list_rows: int = 1 << 16) -> DataFrame:
    """total_laps, anomalies_count, anomaly_rate and the list of anomalous laps per group.

    The list of a group beyond ``list_rows`` laps comes in several rows, numbered by ``list_no``, so
    no cell grows without bound; other groups have one row.
    """
    if "is_anomaly" not in df.columns:
        raise ValueError("column not found: is_anomaly")
    flag = F.col("is_anomaly")
    counts = _grouped(df, keys, F.count(flag).alias("total_laps"), F.count_if(flag).alias("anomalies_count"))
    counts = counts.withColumn("anomaly_rate", F.when(F.col("total_laps") > 0, 100 * F.col("anomalies_count")
                                                      / F.col("total_laps")).otherwise(0.0))
    if seq is None:
        return counts
    lists = (df.where(flag).groupBy(*keys, F.floor((F.col(seq) - 1) / list_rows).alias("_no"))
             .agg(F.sort_array(F.collect_list(F.col(seq))).alias("anomaly_laps")))
    out = counts.join(lists, list(keys), "left") if keys else counts.join(lists, how="left")
    empty = F.array().cast(lists.schema["anomaly_laps"].dataType)
    return out.select(*counts.columns, F.coalesce("_no", F.lit(0)).cast("long").alias("list_no"),
                      F.coalesce("anomaly_laps", empty).alias("anomaly_laps"))


def anomaly_metrics(df: DataFrame, keys: Sequence[str] = (), score: str = "anomaly_score") -> DataFrame:
    """Counts, rate in percent, and the distribution of scores, also per class."""
    flag, s = F.col("is_anomaly"), F.col(score)
    return _grouped(df, keys, F.count(F.lit(1)).alias("n_total"), F.count_if(flag).alias("n_anomalies"),
                    (100 * F.count_if(flag) / F.count(F.lit(1))).alias("anomaly_rate"),
                    F.avg(s).alias("score_mean"), F.stddev_pop(s).alias("score_std"), F.min(s).alias("score_min"),
                    F.max(s).alias("score_max"), F.avg(F.when(flag, s)).alias("anomaly_score_mean"),
                    F.avg(F.when(~flag, s)).alias("normal_score_mean"))


def cliff_summary(cliffs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs, runs with a cliff, validated cliffs and their means per entity."""
    has = F.col("has_cliff")
    n, c = F.count(F.lit(1)), F.count_if(has)
    v = F.count_if(has & F.col("cliff_validated"))
    return cliffs.groupBy(*keys).agg(
        n.alias("total_stints"), c.alias("stints_with_cliff"), F.bround(100.0 * c / n, 1).alias("cliff_rate_pct"),
        v.alias("cliffs_validated"), F.bround(F.when(c > 0, 100.0 * v / c).otherwise(0.0), 1).alias("validated_rate_pct"),
        F.bround(F.avg(F.when(has, F.col("cliff_delta_magnitude"))), 4).alias("mean_cliff_magnitude"),
        F.bround(F.avg(F.when(has, F.col("laps_before_cliff"))), 1).alias("mean_laps_before_cliff"),
        F.bround(F.avg(F.when(has, F.col("pre_cliff_slope"))), 4).alias("mean_pre_cliff_slope"))


def changepoint_metrics(cliffs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Run and cliff counts, rates, mean magnitude and laps before; zeros where there is nothing."""
    has = F.col("has_cliff")
    n, c = F.count(F.lit(1)), F.count_if(has)
    v = F.count_if(has & F.col("cliff_validated"))

    def mean(x: Column) -> Column:
        return F.coalesce(F.avg(F.when(has, x)), F.lit(0.0))

    return _grouped(cliffs, keys, n.alias("n_stints"), c.alias("n_cliffs"),
                    F.when(n > 0, 100.0 * c / n).otherwise(0.0).alias("cliff_rate"), v.alias("n_validated"),
                    F.when(c > 0, 100.0 * v / c).otherwise(0.0).alias("validated_rate"),
                    mean(F.abs("cliff_delta_magnitude")).alias("mean_magnitude"),
                    mean(F.col("laps_before_cliff")).alias("mean_laps_before"))


def quality_score(silhouette_score: Column, laps: Column, anomaly_rate: Column, stints: Column) -> Column:
    """0.40 cluster quality + 0.30 amount of data + 0.20 healthy anomaly rate + 0.10 stints, in [0, 1]."""
    cluster = F.coalesce(clamp(silhouette_score, 0.0, 1.0) * 0.40, F.lit(0.10))
    cluster = F.when(silhouette_score.isNull(), F.lit(0.10)).otherwise(cluster)
    amount = F.least(F.lit(1.0), laps / 30.0) * 0.30
    healthy = F.when(anomaly_rate <= 0.15, (1.0 - anomaly_rate / 0.15) * 0.20).otherwise(0.0)
    return F.bround(cluster + amount + healthy + F.least(F.lit(1.0), stints / 2.0) * 0.10, 3)


def quality_scores(anomalies: DataFrame, keys: Sequence[str], per_entity: DataFrame | None = None,
                   cliffs: DataFrame | None = None) -> DataFrame:
    """(keys, quality_score) for every entity; unknown silhouettes count as such, unknown stints as one."""
    keys = list(keys)
    out = anomalies.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if("is_anomaly").alias("_a"))
    out = (out.join(per_entity.select(*keys, "silhouette_score"), keys, "left") if per_entity is not None
           else out.withColumn("silhouette_score", F.lit(None).cast("double")))
    out = (out.join(cliffs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r")), keys, "left") if cliffs is not None
           else out.withColumn("_r", F.lit(None).cast("long")))
    score = quality_score(F.col("silhouette_score"), F.col("_n"), F.col("_a") / F.col("_n"), F.coalesce("_r", F.lit(1)))
    return out.select(*keys, score.alias("quality_score"))


def score_overview(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("quality_score").alias("mean_score"), F.min("quality_score").alias("min_score"))


def executive_summary(laps: DataFrame, keys: Sequence[str], measure: str, part: Sequence[str] = ()) -> DataFrame:
    """Totals of an analysis: laps, removed zero laps, entities, structural laps, anomalies as text rate.

    Entities are counted from one row each, so distinctness costs a map-side combine, not a set.
    """
    per = laps.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(measure) == 0).alias("_z"),
                                  F.count_if("is_structural").alias("_s"), F.count_if("is_anomaly").alias("_a"))
    out = _grouped(per, part, F.sum("_n").alias("total_laps"), F.sum("_z").alias("zero_laps_removed"),
                   F.count(F.lit(1)).alias("n_drivers"), F.sum("_s").alias("structural_laps"),
                   F.sum("_a").alias("anomalies"))
    return out.withColumn("anomaly_rate", F.format_string("%.2f%%", 100.0 * F.col("anomalies") / F.col("total_laps")))


def top_entities(summary: DataFrame, keys: Sequence[str], by: str = "anomalies_count", n: int = 5) -> DataFrame:
    """The n entities with most anomalies, ties in key order."""
    return summary.orderBy(F.col(by).desc(), *keys).limit(n)


