"""Near-duplicate groups from 64-bit SimHash fingerprints, linked by a generalised pigeonhole search.

A pair within ``radius`` bits over ``parts`` disjoint bit groups must, for every threshold vector
with sum ``radius - parts + 1``, agree up to the threshold in at least one group (a threshold of -1
leaves a group out). So each distinct fingerprint may choose its own vector. It takes the one that
dynamic programming finds cheapest on candidate counts estimated from a bounded sample; a last way
out, the whole fingerprint as one group, bounds the work of a fingerprint in a crowded place. The
chosen variants are joined with the index and verified. Sample and grouping change the cost only,
never the links.

For near duplicates by the similarity of their shingles (:func:`near_duplicates`) the groups of
fingerprints are confirmed first, and a prefix filter, which misses no pair, finds the other links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import components, in_pieces
from paceline.session import discard, stage

BITS = 64
#: Fingerprints read by the driver to group bits and estimate candidate counts, whatever the input.
SAMPLE = 2048
#: A probe is a shuffled row; a candidate is one comparison inside the join.
PROBE_COST = 50


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of all word shingles, repeats included; of the whole sequence if it is shorter. Only A-Z is lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    size = min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, ends[size - 1:].tolist())), np.uint64, len(starts))


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority of the bits of the shingle hashes, as a signed long; 0 without words."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bits of one piece at a time
        octets = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fingerprint") -> DataFrame:
    """Append the fingerprint of every whole text as a signed long; NULL and wordless texts get 0."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return in_pieces(docs).withColumn(name, of(F.col(text)))


def bit_groups(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits cut into ``parts`` groups of near-equal size, correlated bits together."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    if len(bits) < 2:
        bits = np.eye(BITS)
    dev = bits - bits.mean(0)
    norm = np.sqrt((dev ** 2).sum(0))
    corr = np.abs(dev.T @ dev) / np.maximum(np.outer(norm, norm), 1e-9)
    free, groups = set(range(BITS)), []
    for left in range(parts, 0, -1):
        order = sorted(free)
        group = [max(order, key=lambda b: corr[b, order].sum())]
        free.discard(group[0])
        for _ in range((len(order) + left - 1) // left - 1):
            best = max(sorted(free), key=lambda b: corr[b, group].sum())
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def _masks(group: list[int], most: int) -> list[np.ndarray]:
    """For each number of flips up to ``most``, the XOR masks inside the group."""
    return [np.array([sum(1 << b for b in flip) for flip in combinations(group, k)], np.uint64) for k in range(most + 1)]


def thresholds(cost: np.ndarray, goal: int) -> tuple[np.ndarray, np.ndarray]:
    """Cheapest threshold vector with sum ``goal`` of each query, and its cost.

    ``cost[q, part, t + 1]`` is the cost of threshold t, from -1 up. Dynamic programming over the
    groups, on the sum of the thresholds so far.
    """
    queries, parts, steps = cost.shape
    top = steps - 2
    span = parts * (top + 1) + 1  # sums from -parts to parts * top
    best = np.full((queries, span), np.inf)
    best[:, parts] = 0.0
    picks = []
    for p in range(parts):
        new, pick = np.full((queries, span), np.inf), np.full((queries, span), -1)
        for t in range(-1, top + 1):
            come = np.full((queries, span), np.inf)
            if t < 0:
                come[:, :-1] = best[:, 1:] + cost[:, p, :1]
            else:
                come[:, t:] = best[:, :span - t] + cost[:, p, t + 1:t + 2]
            better = come < new
            new, pick = np.where(better, come, new), np.where(better, t, pick)
        best = new
        picks.append(pick)
    rows = np.arange(queries)
    at = np.full(queries, goal + parts)
    total = best[rows, at]
    out = np.zeros((queries, parts), np.int64)
    for p in range(parts - 1, -1, -1):
        out[:, p] = picks[p][rows, at]
        at = at - out[:, p]
    return out, total


def _sample(prints: DataFrame) -> np.ndarray:
    head = prints.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).collect()
    return np.array([r[0] for r in head], np.int64).view(np.uint64)


def _index(prints: DataFrame, groups: list[list[int]], spread: int, whole: bool) -> DataFrame:
    """(part, key, b): each fingerprint under its bits in every group, and under all variants with up to ``spread`` flips."""
    held = []
    for p, group in enumerate(groups):
        own = F.col("fingerprint").bitwiseAND(F.lit(int(np.array([sum(1 << b for b in group)], np.uint64).view(np.int64)[0])))
        for flips in _masks(group, spread):
            held += [F.struct(F.lit(p).alias("part"), own.bitwiseXOR(F.lit(int(x))).alias("key"), F.col("fingerprint").alias("b"))
                     for x in flips.view(np.int64)]
    if whole:
        held.append(F.struct(F.lit(len(groups)).alias("part"), F.col("fingerprint").alias("key"), F.col("fingerprint").alias("b")))
    return prints.select(F.explode(F.array(*held)).alias("r")).select("r.*")


def near_pairs(prints: DataFrame, radius: int = 2, parts: int = 3, spread: int = 0) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints that differ in 1 to ``radius`` bits.

    ``prints`` holds distinct, non-NULL longs in column ``fingerprint``. The index holds each of them
    under all variants with up to ``spread`` flips in a group, which takes as many flips off the
    probes: for a threshold of 2, both sides flip single bits instead of one side flipping two.

    Up to radius 2 a fingerprint in a place so crowded that comparing costs more than the 2,081
    variants of all its bits is probed under these, which bounds its work. A wider radius has no
    such way out.
    """
    size = prints.count()
    sample = _sample(prints)
    groups = bit_groups(sample, parts)
    goal = radius - parts + 1
    top = max(0, min(radius, -(-goal // parts) + 2))
    fields = np.array([sum(1 << b for b in g) for g in groups] + [(1 << BITS) - 1], np.uint64)
    flips = [[max(t - spread, 0) for t in range(top + 1)]] * parts
    masks = [_masks(g, max(flips[0])) for g in groups]
    whole = np.inf
    if radius <= 2:
        masks.append(_masks(list(range(BITS)), radius))
        whole = sum(map(len, masks[-1])) * PROBE_COST
    probes = np.array([[0] + [sum(len(masks[p][k]) for k in range(f + 1)) for f in flips[p]] for p in range(parts)], float) * PROBE_COST
    scale = size / max(1, len(sample))
    base = top + 2

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = pdf["fingerprint"].to_numpy(np.int64).view(np.uint64)
            for at in range(0, len(own), 512):
                q = own[at:at + 512]
                cost = np.repeat(probes[None], len(q), 0)
                for p in range(parts):
                    apart = np.bitwise_count((q[:, None] ^ sample[None]) & fields[p])
                    for t in range(top + 1):
                        cost[:, p, t + 1] += (apart <= t).sum(1) * scale
                chosen, total = thresholds(cost, goal)
                chosen[total > whole] = -1
                code = ((chosen + 1) * base ** np.arange(parts)).sum(1)
                for p in range(len(masks)):
                    # Flips of each query in this group; the last place is the whole fingerprint.
                    depth = np.where(chosen[:, p] < 0, -1, np.maximum(chosen[:, p] - spread, 0)) if p < parts else np.where(total > whole, radius, -1)
                    for k, mask in enumerate(masks[p]):
                        use = depth >= k
                        if use.any():
                            keys = ((q[use] & fields[p])[:, None] ^ mask[None]).ravel()
                            yield pd.DataFrame({"part": np.full(len(keys), p, np.int32), "key": keys.view(np.int64),
                                                "a": np.repeat(q[use].view(np.int64), len(mask)),
                                                "limits": np.repeat(code[use].astype(np.int32), len(mask))})

    asked = prints.select("fingerprint").mapInPandas(search, "part int, key long, a long, limits int")
    signed = [int(f) for f in fields.view(np.int64)]
    index = _index(prints, groups, spread, radius <= 2)
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)  # a pair is taken from the first group that finds it
    for p, f in enumerate(signed[:-1]):
        limit = F.floor(F.col("limits") / base ** p).cast("int") % base - 1
        reach = F.when(limit < 0, F.lit(-1)).otherwise(F.greatest(limit, F.lit(spread)))
        first = first & ((F.col("asked.part") <= p) | (F.bit_count(differ.bitwiseAND(F.lit(f))) > reach))
    found = asked.alias("asked").join(
        index.alias("index"),
        (F.col("asked.part") == F.col("index.part")) & (F.col("asked.key") == F.col("index.key"))
        & (F.col("a") < F.col("b")) & (F.bit_count(differ) <= radius) & first).select("a", "b")
    return found.distinct() if spread else found


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2,
                parts: int = 3) -> DataFrame:
    """(id, fingerprint long, component_id, n_links): one row per row of ``docs``.

    Rows link when their fingerprints differ in at most ``radius`` bits; ``component_id`` is the
    smallest id that links reach, ``n_links`` the number of other distinct fingerprints linked
    directly. Equal texts share a fingerprint, so copies never multiply links. Wordless and NULL
    texts share fingerprint 0; a row with a NULL id takes part, and a group of such rows only has a
    NULL ``component_id``. An empty table gives an empty result. Other columns are ignored.
    """
    prints = stage(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "text", shingle)
                   .select("id", "fingerprint"), "fingerprints")
    classes = stage(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "classes")
    pairs = stage(near_pairs(classes.select("fingerprint"), radius, parts), "pairs")
    roots = components(pairs)
    links = (pairs.select(F.explode(F.array("a", "b")).alias("fingerprint")).groupBy("fingerprint")
             .agg(F.count(F.lit(1)).alias("n_links")))
    rooted = (classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
              .withColumn("root", F.coalesce("root", "fingerprint")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = (rooted.join(least, "root").join(links, "fingerprint", "left")
             .select("fingerprint", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return prints.join(known, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id", "n_links")


def shingles(text: Column, size: int) -> Column:
    """Distinct shingle hashes of a whole text, as an array of longs."""
    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(t, size)).view(np.int64) for t in texts])
    return run(text)


#: One row in ``SAMPLED`` tells which shingles are common; of these at most ``COMMON`` are held, the most frequent.
SAMPLED, COMMON = 8, 1 << 20
#: Rounds of leaders: at most so many, and none after one that merges a smaller share of the sets.
ROUNDS, _ROUND = 3, 0.01
#: Sets of a place that are compared each with each; larger places are given leaders, and the sets near one are compared by their differences from it.
FEW = 16
#: Leaders of a place, one after the other, and the sets far from all so far, in units of ``FEW``, that need no further one.
LEADERS, _LEFT = 6, 8
#: A set is near its leader where they differ in at most this share of the shingles of both.
NEAR = 0.2
#: Bits of a sketch for each shingle, at least, and of a sketch at most.
_DENSE, _WIDEST = 4, 1 << 18
#: Slack of rounding in bounds, on the side that keeps a pair.
_EPS = 1e-9


def _width(n: float) -> int:
    """Bits of the sketch of ``n`` shingles, a power of two."""
    return min(max(64, 1 << (max(1, int(np.ceil(_DENSE * n))) - 1).bit_length()), _WIDEST)


def sketch(hashes: np.ndarray) -> bytes:
    """For each value of the low bits, whether an odd number of the distinct ``hashes`` has it."""
    bits = _width(len(hashes))
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes, bits: int = _WIDEST) -> int:
    """In how many hashes two sets differ at least, by their sketches, folded to one width of at most ``bits``."""
    words = min(len(a), len(b), bits // 8) // 8
    x, y = (np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, words), axis=0) for s in (a, b))
    return int(np.bitwise_count(x ^ y).sum())


def _set_ids(texts: DataFrame, size: int) -> DataFrame:
    """(_id, set, n, fingerprint, sketch): XXH64 of the sorted distinct shingle hashes of each text, their number, and its SimHash; zeros without words."""
    @F.pandas_udf("struct<set:long,n:int,fingerprint:long,sketch:binary>")
    def run(values: pd.Series) -> pd.DataFrame:
        own = [np.unique(shingle_hashes(t, size)) for t in values]
        ids = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) if len(s) else 0 for s in own], np.uint64)
        return pd.DataFrame({"set": ids.view(np.int64), "n": np.array([len(s) for s in own], np.int32),
                             "fingerprint": np.array([fingerprint(t, 3) for t in values], np.int64), "sketch": [sketch(s) for s in own]})
    return in_pieces(texts).withColumn("_s", run("_text")).select("_id", "_s.set", "_s.n", "_s.fingerprint", "_s.sketch")


def _common(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes, ascending, that occur in at least three texts of the sample, and in how many."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = [np.unique(shingle_hashes(t, size)) for t in pdf["_text"].dropna().unique()]
            if own:
                key, n = np.unique(np.concatenate(own), return_counts=True)
                yield pd.DataFrame({"key": key.view(np.int64), "n": n})

    part = in_pieces(texts.where(F.pmod(F.xxhash64("_id.row"), F.lit(SAMPLED)) == 0).select("_text"))
    counts = stage(part.mapInPandas(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n >= 3"), "common")
    least, held = 3, 0
    for n, kinds in sorted(counts.select(F.least("n", F.lit(10_000)).alias("n")).groupBy("n").count().collect(), reverse=True):
        held += kinds
        if held > COMMON:
            least = n + 1
            break
    top = counts.where(F.col("n") >= least).toPandas() if least <= 10_000 else pd.DataFrame({"key": [], "n": []})
    key, n = top["key"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(key)
    return key[order], n[order]


def _prefixes(texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """(key, set, n, pos): the first shingles of every text in one order of all shingles, common ones last.

    Two sets with ``similarity`` share a shingle among their first ``n - ceil(similarity * n) + 1``,
    whatever the order; so what the sample says of common shingles changes the cost only.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_common(texts, size))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common, times = shared.value
        seen: set[int] = set()  # copies within a task are given once, as far as this has room
        for pdf in batches:
            held = []
            for text in pdf["_text"]:
                own = np.unique(shingle_hashes(text, size))
                n = len(own)
                name = np.array([xxhash.xxh64_intdigest(own.tobytes(), 7)], np.uint64).view(np.int64)[0]
                if not n or name in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(name)
                often = np.zeros(n, np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    often = np.where(common[at] == own, times[at], 0)
                take = n - int(np.ceil(similarity * n - _EPS)) + 1
                first = np.lexsort((own, often))[:take]
                held.append((own[first].view(np.int64), np.full(take, name), np.full(take, n, np.int32), np.arange(take, dtype=np.int32)))
            if held:
                yield pd.DataFrame(dict(zip(("key", "set", "n", "pos"), map(np.concatenate, zip(*held)))))

    return in_pieces(texts.select("_text")).mapInPandas(run, "key long, set long, n int, pos int")


def _possible(left: str, right: str, similarity: float) -> Column:
    """Whether sizes, and the places of a first shared shingle, leave room for ``similarity``."""
    na, nb = F.col(f"{left}.n"), F.col(f"{right}.n")
    room = F.least(na - F.col(f"{left}.pos"), nb - F.col(f"{right}.pos"))
    return ((F.least(na, nb) >= F.greatest(na, nb) * similarity - _EPS)
            & (room * (1 + similarity) >= (na + nb) * similarity - _EPS))


def _shingled(wanted: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(set, s): the ``wanted`` sets with their shingle hashes."""
    asked = classes.join(wanted, "set")
    own = texts.join(asked.select(F.col("least").alias("_own"), "set"), F.col("_id.row") == F.col("_own.row"))
    return stage(in_pieces(own).select("set", shingles(F.col("_text"), shingle).alias("s")), "shingles")


def _sketched(pairs: DataFrame, classes: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with the sketches and sizes of the sets of columns ``a`` and ``b``, as _x, _xn, _y and _yn."""
    for name, as_ in ((a, "_x"), (b, "_y")):
        pairs = pairs.join(classes.select(F.col("set").alias(name), F.col("sketch").alias(as_), F.col("n").alias(f"{as_}n")), name)
    return in_pieces(pairs)


def _likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` whose sketches leave room for ``similarity``; sets that have it differ in at most ``_slack`` of the shingles of both."""
    @F.pandas_udf("int")
    def least(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([apart(i, j) for i, j in zip(x, y)], dtype="int32")
    met = _sketched(pairs, classes, "a", "b")
    return met.where(least("_x", "_y") <= _slack(similarity) * (F.col("_xn") + F.col("_yn")) + 1e-6).select("a", "b")


def _slack(similarity: float) -> float:
    return (1 - similarity) / (1 + similarity)


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The ``pairs`` of sets that have ``similarity`` (Jaccard)."""
    sets = _shingled(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), classes, texts, shingle)
    both, na, nb = F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb")
    same = (pairs.join(sets.select(F.col("set").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("set").alias("b"), F.col("s").alias("sb")), "b")
            .where(both >= similarity * (na + nb - both)).select("a", "b"))
    done = stage(same, "similar")
    discard(sets)
    return done


def _led(classes: DataFrame) -> DataFrame:
    """(a, b): each set with the smallest one of its group of SimHash fingerprints within 2 bits."""
    pairs = stage(near_pairs(classes.select("fingerprint").distinct()), "pairs")
    roots = components(pairs)
    grouped = (classes.where("n > 0").join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
               .select("set", F.coalesce("root", "fingerprint").alias("root")))
    lead = grouped.groupBy("root").agg(F.min("set").alias("lead"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    led = stage(grouped.join(lead, "root").where("set != lead").select(F.col("lead").alias("a"), F.col("set").alias("b")), "led")
    for t in (pairs, roots):
        discard(t)
    return led


def _open(index: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The places of ``index`` that hold sets which no links connect so far, with the root of each set."""
    own = _rooted(index.drop("root"), roots)
    places = own.groupBy("key").agg(F.min("root").alias("_least"), F.max("root").alias("_most")).where("_least != _most").select("key")
    return stage(own.join(places, "key"), "live")


def _asked(live: DataFrame, similarity: float, salt: int) -> DataFrame:
    """(a, b), a < b: sets with the leader of a place of the index, where no links connect them so far.

    The leader is first in a hash order that differs between places and salts.
    """
    lead = (live.groupBy("key").agg(F.min(F.struct(F.xxhash64("set", "key", F.lit(salt)).alias("h"), "set", "n", "pos", "root")).alias("l"))
            .select("key", "l.set", "l.n", "l.pos", "l.root"))
    met = live.alias("x").join(lead.alias("y"), "key").where(F.col("x.root") != F.col("y.root"))
    return stage(_pairs(met.where(_possible("x", "y", similarity))), "asked")


def _each(places: DataFrame, by: list[str], similarity: float) -> DataFrame:
    """(a, b), a < b: each set with each of its place, told by the columns ``by``, where no links connect them so far."""
    met = places.alias("x").join(places.alias("y"), by).where((F.col("x.set") < F.col("y.set")) & (F.col("x.root") != F.col("y.root")))
    return _pairs(met.where(_possible("x", "y", similarity)))


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b")).distinct()


def _rooted(sets: DataFrame, roots: DataFrame | None, name: str = "set", root: str = "root") -> DataFrame:
    """``sets`` with what links connect the sets of column ``name`` to so far, in column ``root``."""
    if roots is None:
        return sets.withColumn(root, F.col(name))
    return (sets.join(roots.select(F.col("node").alias(name), F.col("root").alias(root)), name, "left")
            .withColumn(root, F.coalesce(root, name)))


def _crowds(live: DataFrame, classes: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(a, b): all pairs of the places with few sets, of leaders, and of sets far from all leaders of their place;
    and (lead, set, n, lead_n): the sets of the other places with the leaders they are near.

    The sets of a large place are cut by size into overlapping bands, so that two of near sizes share one,
    and the leader of a band is first in a hash order of all sets, so places with the same sets have the same leaders.
    Sets far from it get another leader, as long as there are many; the rest is compared each with each.

    How far a set is from its leader is told by their sketches, all at the width that the smallest set of a band with
    that leader has, so the distance is a metric. A set similar to one near the leader is among those that count as near
    with the slack that this leaves; so two similar sets are in the crowd of one leader, or both far from it.
    """
    step = max(-np.log(similarity) * (1 + 1e-6), 1e-3)
    smallest = np.exp(-2 * step) * (1 - 1e-6)  # of a band, as a share of any other

    @F.pandas_udf("int")
    def least(x: pd.Series, y: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([apart(i, j, _width(k * smallest)) for i, j, k in zip(x, y, n)], dtype="int32")

    many = live.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW).select("key")
    pairs = [_each(live.join(many, "key", "left_anti"), ["key"], similarity)]
    band = F.floor(F.log("n") / step)
    place, rest = ["key", "band"], live.join(many, "key").select("*", F.explode(F.array(band, band + 1)).alias("band"))
    rest, held, crowds = stage(rest, "places"), [], []
    n, lead_n, slack = F.col("n"), F.col("lead_n"), _slack(similarity)
    for salt in range(ROUNDS, ROUNDS + LEADERS):
        held.append(rest)
        lead = (rest.groupBy(*place).agg(F.min(F.struct(F.xxhash64("set", F.lit(salt)).alias("h"), "set", "n")).alias("l"))
                .select(*place, F.col("l.set").alias("lead"), F.col("l.n").alias("lead_n")))
        led = rest.join(lead, place).where("set != lead")
        asked = _sketched(led.select("lead", "set", "n", "lead_n").distinct(), classes, "lead", "set")
        told = stage(asked.select("lead", "set", "n", "lead_n", least("_x", "_y", "lead_n").alias("least")), "led")
        held.append(told)
        crowds.append(told.where(F.col("least") <= NEAR * (n / similarity + lead_n) + slack * n * (1 + 1 / similarity) + 1e-6).drop("least"))
        alike = (F.least(n, lead_n) >= F.greatest(n, lead_n) * similarity - _EPS) & (F.col("least") <= slack * (n + lead_n) + 1e-6)
        pairs.append(told.where(alike).select(F.least("lead", "set").alias("a"), F.greatest("lead", "set").alias("b")))
        far = stage(led.join(told.where(F.col("least") > NEAR * (n + lead_n)).select("lead", "set"), ["lead", "set"]).select(*rest.columns), "places")
        held.append(far)
        large = far.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > _LEFT * FEW).select(*place)
        pairs.append(_each(far.join(large, place, "left_anti"), place, similarity))
        rest = stage(far.join(large, place), "places")
        if rest.isEmpty():
            break
    held.append(rest)
    pairs.append(_each(rest, place, similarity))
    found = stage(reduce(DataFrame.unionByName, pairs).distinct(), "asked"), stage(reduce(DataFrame.unionByName, crowds).distinct(), "crowds")
    for table in held:
        discard(table)
    return found


def _strays(crowds: DataFrame, roots: DataFrame | None, classes: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b): pairs of sets of a crowd, not both linked with its leader, that may have ``similarity``.

    Sets are told apart by what they differ in from the leader. With c = (1 - similarity) / (1 + similarity) two similar sets
    x and y differ in at most c(nx + ny) shingles, so their differences dx and dy from the leader have at least
    (|dx| + |dy| - c(nx + ny)) / 2 in common. A set that is not similar to the leader has |d| > c(n + lead_n): that bound
    is above 0 for each pair asked for here, and a prefix filter on the differences, rare ones first, misses none.
    """
    c, eps = _slack(similarity), 1e-6
    held = _rooted(_rooted(crowds, roots), roots, "lead", "lead_root").withColumn("stray", F.col("root") != F.col("lead_root"))
    mixed = held.where("stray").select("lead").distinct()
    held = stage(held.drop("lead_root").join(mixed, "lead"), "held")
    sets = _shingled(held.select("set").union(held.select("lead")).distinct(), classes, texts, shingle)
    apart = (held.join(sets, "set").join(sets.select(F.col("set").alias("lead"), F.col("s").alias("_l")), "lead")
             .withColumn("d", F.concat(F.array_except("s", "_l"), F.array_except("_l", "s"))).drop("s", "_l"))
    size = F.col("size")
    t = F.greatest(F.lit(1), F.ceil((size - c * F.col("n") + c * F.col("lead_n")) / 2 - eps))
    wide = F.greatest(F.lit(1), F.ceil((size - c * (F.col("n") + F.col("lead_n"))) / (1 + c) - eps))
    loose = stage(apart.select("lead", "set", "n", "root", "stray", "lead_n", F.size("d").alias("size"), F.explode("d").alias("e")), "loose")
    times = loose.groupBy("lead", "e").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    ranked = (loose.join(times, ["lead", "e"], "left")
              .groupBy("lead", "set", "n", "root", "stray", "lead_n", "size")
              # Differences of one set alone come first in the order; only their number matters.
              .agg(F.sort_array(F.collect_list(F.when(F.col("times").isNotNull(), F.struct("times", "e")))).alias("es"))
              .withColumn("alone", size - F.size("es")).withColumn("near", size - t + 1).withColumn("far", size - wide + 1))
    reach = F.when(F.col("stray"), F.greatest("near", "far")).otherwise(F.col("near"))
    first = stage(ranked.withColumn("es", F.slice("es", F.lit(1), F.greatest(F.lit(0), reach - F.col("alone")).cast("int")))
                  .select("lead", "set", "n", "root", "stray", "size", "alone", "near", "far", F.posexplode("es").alias("at", "_e"))
                  .select("lead", "set", "n", "root", "stray", "size", "near", "far", F.col("_e.e").alias("e"),
                          (F.col("alone") + F.col("at")).alias("pos")), "differences")
    shared = F.least(F.col("x.size") - F.col("x.pos"), F.col("y.size") - F.col("y.pos"))
    may = ((F.col("x.root") != F.col("y.root"))
           & (F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * similarity - eps)
           & (2 * shared >= F.col("x.size") + F.col("y.size") - c * (F.col("x.n") + F.col("y.n")) - eps))
    alike = first.where("stray and pos < near")
    inside = alike.alias("x").join(alike.alias("y"), ["lead", "e"]).where(may & (F.col("x.set") < F.col("y.set")))
    across = (first.where("stray and pos < far").alias("x")
              .join(first.where("not stray and pos < near").alias("y"), ["lead", "e"]).where(may))
    asked = stage(_pairs(inside).union(_pairs(across)).distinct(), "asked")
    for table in (held, sets, loose, first):
        discard(table)
    return asked


def near_duplicates(docs: DataFrame, row: str, id_col: str = "doc_id", text: str = "text", shingle: int = 5,
                    similarity: float = 0.8) -> DataFrame:
    """(row, kept): the rows of ``docs`` and whether each stays; one of each group of near duplicates does.

    ``row`` is a unique column. Two rows link when the sets of their ``shingle``-word shingles have
    ``similarity`` (Jaccard); a group is everything that links reach, and its smallest id (NULL ids
    first, then row) stays. Equal sets are one class. SimHash leads: each class is compared with the
    smallest of its group of fingerprints, which merges crowds. Then classes that share a shingle of
    their prefixes are compared: first with a leader of each place in a few rounds, then each with
    each, in a crowded place those near a leader whose differences from it allow it. Pairs whose sketches show too many differences are not
    confirmed. All classes take part to the end; only pairs that links connect already are left out, so
    fingerprints change the cost, and the links of the rest are found as well.

    Wordless and NULL texts are one group; repeated rows are alike, so one stays. Whole texts count,
    however long. An empty table gives an empty result. Other columns, whatever their names, are ignored.
    """
    texts = docs.select(F.struct(F.col(id_col).alias("id"), F.col(row).alias("row")).alias("_id"), F.col(text).alias("_text"))
    classes = stage(_set_ids(texts, shingle).groupBy("set").agg(F.min("_id").alias("least"), F.max("n").alias("n"),
                                                                F.min("fingerprint").alias("fingerprint"),
                                                                F.max("sketch").alias("sketch")), "classes")
    links, roots = None, None

    def linked(asked: DataFrame) -> int:
        """Add the links among the ``asked`` pairs; how many there are."""
        nonlocal links, roots
        likely = stage(_likely(asked, classes, similarity), "likely")
        discard(asked)
        same = _confirmed(likely, classes, texts, shingle, similarity)
        discard(likely)
        found = same.count()
        if not found:
            return 0
        if links is None:
            links = same
        else:
            # A root and its members carry on what was linked before.
            links = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(same)
        old, roots = roots, components(links)
        for t in (same, old):
            if t is not None:
                discard(t)
        return found

    linked(_led(classes))
    first = stage(_prefixes(texts, shingle, similarity), "prefixes")
    met = first.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    live = stage(first.join(met, "key").groupBy("key", "set").agg(F.min("n").alias("n"), F.min("pos").alias("pos")), "index")
    discard(first)
    enough = _ROUND * classes.count()
    for salt in range(ROUNDS):
        last, live = live, _open(live, roots)
        discard(last)
        if linked(_asked(live, similarity, salt)) <= enough:
            break
    last, live = live, _open(live, roots)
    discard(last)
    pairs, crowds = _crowds(live, classes, similarity)
    discard(live)
    if roots is not None:
        every, pairs = pairs, stage(_rooted(_rooted(pairs, roots, "a", "_a"), roots, "b", "_b").where("_a != _b").select("a", "b"), "asked")
        discard(every)
    linked(pairs)
    linked(_strays(crowds, roots, classes, texts, shingle, similarity))
    discard(crowds)
    own = classes
    if roots is not None:
        own = classes.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("set", F.coalesce("root", "set"))
    kept = own.groupBy("set").agg(F.min("least").alias("least")).select(F.col("least.row").alias("head"))
    return docs.select(row).join(kept, F.col(row) == F.col("head"), "left").select(row, F.col("head").isNotNull().alias("kept"))
