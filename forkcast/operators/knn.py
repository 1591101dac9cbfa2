"""Exact k-nearest-neighbour imputation (IMP2, JN3, JN4) without an
all-pairs join.

Semantics (scikit-learn's KNN imputer with ``weights='distance'``):

* features = targets then predictors (deduplicated), D of them, unscaled;
* distance between rows a, b = sqrt(D / m * sum over the m columns present
  in both of (a_i - b_i)^2), undefined when m = 0;
* per target column: donors are the rows where it is present, the k
  nearest are used (all if fewer), ties broken by (distance, donor id);
* weights 1/d; if a chosen donor is at d = 0 only the d = 0 donors count,
  equally; undefined distances weigh 0; when every distance is undefined
  the donors' mean is used;
* only originally missing cells are written.

Plan (exact, no all-pairs join).  For one target, a receiver's presence
pattern p_r and a donor's pattern p_d fix the shared columns S, and the
distance is Euclidean on S scaled by sqrt(D/|S|).  So each (p_r, p_d)
pair is a plain Euclidean k-NN problem:

1. donors keep at most k rows per distinct point on S (smallest ids; a
   duplicate-heavy point cannot blow up a block) and receivers are reduced
   to distinct points on S (their answers are identical);
2. a pair's donors are cut into blocks of up to ``block`` rows by the splits
   of a k-d tree built on a bounded sample (as a range partitioner does, with
   at most ``MOST_BLOCKS`` a pair); every receiver falls into one block.  A
   crowded block of receivers is cut into pieces of ``block`` rows;
3. in a block (``search``) donors and receivers are split at medians of their
   widest side until a leaf holds ``leaf`` of them, wherever and however dense
   they lie; a receiver looks into its nearest leaf first and then into those
   whose box is nearer than its k-th best so far.  That is the pair count:
   it follows the leaves that a ball around the receiver touches, not cells;
4. the k-th distance found in its own block bounds a receiver's ball; the
   other blocks whose box the ball meets are searched in a second round;
5. per receiver the pair results are merged, the k nearest kept
   (``row_number`` with WindowGroupLimit, so each task ships at most k
   rows per key) and the weighted mean computed; a left join writes it
   back into the missing cells only.

A task holds one block of donors and one piece of receivers; the driver holds
the sample, the splits and one box a block.  The working table, the capped
donors, the receivers and both rounds' results are written as tables under the
session's reliable checkpoint folder, so a lost executor recomputes one step.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forkcast.functions.text import nan_to_null
from forkcast.session import ensure_checkpoint_dir, materialize

# The reference's target and predictor columns and k.
TARGETS = ("rating_number", "votes")
PREDICTORS = ("cost", "cost_2", "lat", "lng")
N_NEIGHBORS = 5

#: Blocks of a pair, and sampled donors behind all their splits, at most.
MOST_BLOCKS = 4096
SAMPLED = 65_536
#: A box is left out only if it is farther by this relative margin.
_MARGIN = 1 + 1e-9


def knn_impute(df: DataFrame, targets=TARGETS, predictors=PREDICTORS, k: int = N_NEIGHBORS,
               id_col: str = "id", require_predictors: bool = False, block: int = 50_000, leaf: int = 64) -> DataFrame:
    """Fill missing cells of ``targets`` from the k nearest rows."""
    targets = [c for c in targets if c in df.columns]
    predictors = [c for c in predictors if c in df.columns]
    if not targets or (require_predictors and not predictors):
        return df
    cols = list(dict.fromkeys(targets + predictors))
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    work = df.select(F.col(id_col).alias("_id"), *[nan_to_null(F.col(c)).cast("double").alias(c) for c in cols])
    work = materialize(work, "knn-work")        # read many times below: compute once
    stats = _pattern_stats(work, cols, targets)
    plans = [p for p in (_plan_target(work, cols, t, stats[t]) for t in targets)
             if p is not None]
    if not plans:
        return df
    found = _search_and_weigh(plans, len(cols), k, block, leaf)
    # one row per receiver with a value per target, then ONE left join back
    ts = [p["t"] for p in plans]
    imp = found.groupBy(F.col("_id").alias("__rid")).agg(
        *[F.max(F.when(F.col("_t") == t, F.col("_value"))).alias(f"__imp_{t}") for t in ts])
    out = df.join(imp, df[id_col] == imp["__rid"], "left")
    out = out.withColumns({t: F.coalesce(nan_to_null(F.col(t)), F.col(f"__imp_{t}")) for t in ts})
    return out.drop("__rid", *[f"__imp_{t}" for t in ts])


def _pattern(cols: list[str]):
    return reduce(lambda a, b: a + b,
                  [F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(cols)])


def _pattern_stats(work: DataFrame, cols: list[str], targets: list[str]) -> dict:
    """Per target, per side (receiver / donor) and presence pattern: row
    count and the donors' sum of the target.  ONE aggregate job for all
    targets (at most 2^D rows each)."""
    recs = [F.struct(F.lit(t).alias("_t"), F.col(t).isNotNull().alias("_is_donor"), _pattern([c for c in cols if c != t]).alias("_pat"), F.col(t).alias("_v")) for t in targets]
    rows = (work.select(F.explode(F.array(*recs)).alias("_r")).select("_r.*")
                .groupBy("_t", "_is_donor", "_pat").agg(F.count(F.lit(1)).alias("n"), F.sum("_v").alias("sum_v")).collect())
    out = {t: {"r": {}, "d": {}} for t in targets}
    for r in rows:
        out[r["_t"]]["d" if r["_is_donor"] else "r"][r["_pat"]] = {"n": r["n"], "sum_v": r["sum_v"]}
    return out


def _plan_target(work: DataFrame, cols: list[str], t: str, stats: dict) -> dict | None:
    """Receivers, donors and the (receiver pattern, donor pattern) pairs of
    one target column, each with its shared columns and donor count."""
    others = [c for c in cols if c != t]
    pat = _pattern(others).alias("_pat")
    recv = work.where(F.col(t).isNull()).select("_id", *others, pat)
    donors = work.where(F.col(t).isNotNull()).select(F.col("_id").alias("_did"), F.col(t).alias("_v"), *others, pat)
    rstat, dstat = stats["r"], stats["d"]
    if not rstat or not dstat:
        return None                                        # nothing missing, or nothing to learn from
    n_d = sum(s["n"] for s in dstat.values())
    mean = sum(s["sum_v"] for s in dstat.values()) / n_d
    pairs = []
    for rp in rstat:
        for dp, ds in dstat.items():
            S = [c for i, c in enumerate(others) if (rp >> i) & 1 and (dp >> i) & 1]
            if S:                                          # else undefined distances: weight 0
                pairs.append(dict(rp=rp, dp=dp, S=S, n=ds["n"]))
    return dict(t=t, recv=recv, donors=donors, pairs=pairs, mean=mean, receivers=[s["n"] for s in rstat.values()])


def kd_leaves(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): rows cut at the median of the widest side until a
    piece holds at most ``size`` rows or one distinct point; piece i is
    order[starts[i]:starts[i + 1]]."""
    order, starts = np.arange(len(points)), []
    todo = [(0, len(points))] if len(points) else []
    while todo:
        lo, hi = todo.pop()
        inside = points[order[lo:hi]]
        width = inside.max(0) - inside.min(0) if hi - lo > size else np.zeros(1)
        side = int(np.argmax(width))
        if width[side] <= 0:
            starts.append(lo)
            continue
        half = (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(inside[:, side], half)]
        todo += [(lo, lo + half), (lo + half, hi)]
    return order, np.array([*sorted(starts), len(points)])


def _boxes(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum.reduceat(points, starts[:-1]), np.maximum.reduceat(points, starts[:-1])


def _box_distance(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    total = np.zeros((len(points), len(lo)))
    for s in range(points.shape[1]):
        x = points[:, s, None]
        total += np.maximum(np.maximum(lo[None, :, s] - x, x - hi[None, :, s]), 0.0) ** 2
    return total


def search(receivers: np.ndarray, donors: np.ndarray, ids: np.ndarray, k: int, scale: float = 1.0, bound: np.ndarray | None = None,
           leaf: int = 64) -> tuple[np.ndarray, np.ndarray, int]:
    """(dist, place, pairs): per receiver its k nearest donors by (distance,
    id), places in ``donors`` (-1: none, distance infinite) and the number of
    pairs whose distance was computed.  Distances are sqrt(scale * squares);
    only donors within a receiver's ``bound`` are looked for."""
    rank = np.unique(ids, return_inverse=True)[1]
    best = np.full((len(receivers), k), np.inf)
    place = np.full((len(receivers), k), -1, np.int64)
    pairs = 0
    if not len(receivers) or not len(donors):
        return best, place, pairs
    limit = np.full(len(receivers), np.inf) if bound is None else bound * _MARGIN
    d_order, d_starts = kd_leaves(donors, leaf)
    lo, hi = _boxes(donors[d_order], d_starts)
    r_order, r_starts = kd_leaves(receivers, leaf)

    def look(rows: np.ndarray, j: int) -> int:
        """Rows (places in ``receivers``) against donor leaf j."""
        inside = d_order[d_starts[j]:d_starts[j + 1]]
        squares = np.zeros((len(rows), len(inside)))
        for s in range(donors.shape[1]):  # column by column, as the sum is written in SQL
            squares += (receivers[rows, s, None] - donors[None, inside, s]) ** 2
        new = np.sqrt(scale * squares)
        near = new <= best[rows, k - 1, None]  # farther donors change nothing, so only these are sorted
        better, used = near.any(1), near.any(0)
        if not better.any():
            return squares.size
        rows, new = rows[better], new[better][:, used]
        dist = np.concatenate([best[rows], new], axis=1)
        who = np.concatenate([place[rows], np.broadcast_to(inside[used], new.shape)], axis=1)
        first = np.lexsort((np.where(who < 0, len(rank), rank[who]), dist), axis=1)[:, :k]
        best[rows], place[rows] = np.take_along_axis(dist, first, 1), np.take_along_axis(who, first, 1)
        limit[rows] = np.minimum(limit[rows], best[rows, k - 1] * _MARGIN)
        return squares.size

    for a, b in zip(r_starts[:-1], r_starts[1:]):
        rows = r_order[a:b]
        away = np.sqrt(scale * _box_distance(receivers[rows], lo, hi))
        nearest = np.argmin(away, axis=1)
        near_enough = away[np.arange(len(rows)), nearest] <= limit[rows]
        for j in np.unique(nearest[near_enough]):
            pairs += look(rows[near_enough & (nearest == j)], j)
        away[np.arange(len(rows)), nearest] = np.inf
        lowest = away.min(0)
        for j in np.argsort(lowest):
            if lowest[j] > limit[rows].max() or lowest[j] == np.inf:
                break
            more = rows[(away[:, j] <= limit[rows]) & (away[:, j] < np.inf)]  # infinite: seen
            if len(more):
                pairs += look(more, j)
    place[np.isinf(best)] = -1
    return best, place, pairs


def _splits(points: np.ndarray, blocks: int) -> list[tuple]:
    """A k-d tree over sampled points as (side, cut, left, right) nodes;
    leaves are ~block.  Node 0 is the root; rows below the cut go left."""
    nodes, todo, leaves = [], [(points, blocks, None, 0)], 0
    while todo:
        inside, want, parent, which = todo.pop()
        width = inside.max(0) - inside.min(0) if want > 1 and len(inside) > 1 else np.zeros(1)
        side = int(np.argmax(width))
        if width[side] <= 0:
            ref = ~leaves
            leaves += 1
        else:
            values = np.sort(inside[:, side])
            cut = values[len(values) // 2]
            if cut == values[0]:
                cut = values[values > cut][0]
            ref = len(nodes)
            nodes.append([side, float(cut), 0, 0])
            below = inside[:, side] < cut
            todo += [(inside[below], want // 2, ref, 2), (inside[~below], want - want // 2, ref, 3)]
        if parent is not None:
            nodes[parent][which] = ref
    return [tuple(n) for n in nodes]


def _route(points: np.ndarray, nodes: list[tuple]) -> np.ndarray:
    """Block of every point."""
    out = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))] if nodes else []
    while todo:
        ref, rows = todo.pop()
        if ref < 0:
            out[rows] = ~ref
        elif len(rows):
            side, cut, left, right = nodes[ref]
            below = points[rows, side] < cut
            todo += [(left, rows[below]), (right, rows[~below])]
    return out


def _in_blocks(rows: DataFrame, s_names: list[str], trees: dict) -> DataFrame:
    """``rows`` with ``_block``; without any splits no Python runs."""
    if not trees:
        return rows.withColumn("_block", F.lit(0).cast("long"))

    def run(batches):
        for batch in batches:
            pair = batch.column("_pair").to_numpy(zero_copy_only=False)
            points = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in s_names], axis=1)
            block = np.zeros(len(pair), np.int64)
            for p in np.unique(pair):
                if p in trees:
                    block[pair == p] = _route(points[pair == p], trees[p])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=[*batch.schema.names, "_block"])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", _block long")


def _searched(receivers: DataFrame, donors: DataFrame, s_names: list[str], D: int, k: int, leaf: int, most: int | None, tasks: int = 0) -> DataFrame:
    """(_rid, _did, _v, _dist) of each receiver's k nearest within ``_bound``
    in its (_pair, _block).  Blocks of more than ``most`` receivers are cut
    into pieces, each with a copy of the donors (None: there are none).
    ``tasks`` (0: as Spark joins them by bytes, which says little of a
    search's time) deal the pieces out."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        column = lambda table, c: table.column(c).to_numpy()
        points = [np.stack([column(t, c) for c in s_names], axis=1).astype(float) for t in (left, right)]
        scale = D / float(column(left, "_m")[0]) if left.num_rows else 1.0
        best, place, _ = search(*points, column(right, "_did"), k, scale, column(left, "_bound"), leaf)
        row, nth = np.nonzero(place >= 0)
        chosen = place[row, nth]
        return pa.table([pa.array(column(left, "_rid")[row]), right.column("_did").take(pa.array(chosen)), right.column("_v").take(pa.array(chosen)), pa.array(best[row, nth])],
                        names=["_rid", "_did", "_v", "_dist"])

    piece = F.lit(0).cast("long").alias("_piece")
    if most is None:
        receivers, copies = receivers.select("*", piece), donors.select("*", piece)
    else:
        many = receivers.groupBy("_pair", "_block").agg(F.ceil(F.count("*") / most).alias("_n"))
        receivers = receivers.join(many, ["_pair", "_block"]).withColumn("_piece", F.pmod(F.xxhash64("_rid"), F.col("_n")).cast("long")).drop("_n")
        copies = donors.join(many, ["_pair", "_block"]).withColumn("_piece", F.explode(F.expr("sequence(0L, _n - 1)"))).drop("_n")
    keys = ["_pair", "_block", "_piece"]
    if tasks:
        receivers, copies = receivers.repartition(tasks, *keys), copies.repartition(tasks, *keys)
    return receivers.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(run, f"_rid long, _did {dict(donors.dtypes)['_did']}, _v double, _dist double")


def _search_and_weigh(plans: list[dict], D: int, k: int, block: int, leaf: int) -> DataFrame:
    """All pairs of all targets at once; (_t, _id, _value) of every receiver cell."""
    n_s = D - 1
    s_names = [f"_s{j}" for j in range(n_s)]

    def side(frame, key, entries, keep):
        """ONE scan of a side: every row emits the pairs its presence
        pattern belongs to (filtered array, exploded)."""
        struct = lambda pid, q: F.struct(
            F.lit(pid).alias("_pair"), F.lit(len(q["S"])).alias("_m"),
            *[c.cast("double").alias(s_names[j]) for j, c in enumerate([F.col(c) for c in q["S"]] + [F.lit(0.0)] * (n_s - len(q["S"])))])
        arr = F.array(*[F.when(F.col("_pat") == F.lit(q[key]), struct(pid, q)) for pid, q in entries])
        return frame.select(*keep, F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("_q")).select(*keep, "_q.*")

    r_parts, d_parts, sizes = [], [], {}
    for p in plans:
        entries = [(len(sizes) + i, q) for i, q in enumerate(p["pairs"])]
        sizes.update((pid, q["n"]) for pid, q in entries)
        if entries:
            r_parts.append(side(p["recv"], "rp", entries, ["_id"]).select(F.lit(p["t"]).alias("_t"), "_id", "_pair", "_m", *s_names))
            d_parts.append(side(p["donors"], "dp", entries, ["_did", "_v"]).select("_did", "_v", "_pair", *s_names))
    recv_all = reduce(DataFrame.unionByName, [p["recv"].select(F.lit(p["t"]).alias("_t"), "_id") for p in plans])
    means = F.create_map(*[x for p in plans for x in (F.lit(p["t"]), F.lit(p["mean"]).cast("double"))])
    if not r_parts:
        return recv_all.select("_t", "_id", means[F.col("_t")].alias("_value"))
    key_cols = ["_pair", *s_names]
    r_all, d_all = reduce(DataFrame.unionByName, r_parts), reduce(DataFrame.unionByName, d_parts)
    wpt = Window.partitionBy(*key_cols).orderBy("_did")
    d_all = d_all.withColumn("_rn", F.row_number().over(wpt)).where(F.col("_rn") <= k).drop("_rn")
    trees = {}
    large = {pid: min(MOST_BLOCKS, math.ceil(n / block)) for pid, n in sizes.items() if n > block}
    if large:
        d_all = materialize(d_all, "knn-donors")
        every = max(1, sum(sizes[p] for p in large) // SAMPLED)
        picked = d_all.where(F.col("_pair").isin(list(large)) & (F.pmod(F.xxhash64("_did", "_pair"), F.lit(every)) == 0)).select("_pair", *s_names).toPandas()
        trees = {int(p): _splits(g[s_names].to_numpy(), large[p]) for p, g in picked.groupby("_pair")}
    d_all = materialize(_in_blocks(d_all, s_names, trees), "knn-donors")
    r_pts = r_all.select("_pair", "_m", *s_names).distinct().withColumn("_rid", F.monotonically_increasing_id())
    r_pts = materialize(_in_blocks(r_pts, s_names, trees), "knn-receivers")
    most = block if max(rs for p in plans for rs in p["receivers"]) > block else None
    tasks = min(MOST_BLOCKS, sum(large.values()))
    found = _searched(r_pts.withColumn("_bound", F.lit(math.inf)), d_all, s_names, D, k, leaf, most, tasks)
    if trees:
        found = materialize(found, "knn-own")
        boxes = {}
        for r in d_all.groupBy("_pair", "_block").agg(*[f(c).alias(f"{f.__name__}{c}") for c in s_names for f in (F.min, F.max)]).collect():
            boxes.setdefault(r["_pair"], []).append((r["_block"], [r[f"min{c}"] for c in s_names], [r[f"max{c}"] for c in s_names]))
        boxes = {p: (np.array([b for b, _, _ in v]), np.array([x for _, x, _ in v]), np.array([x for _, _, x in v])) for p, v in boxes.items() if len(v) > 1}
        kth = found.groupBy("_rid").agg(F.when(F.count("*") >= k, F.max("_dist")).alias("_bound"))
        rows = r_pts.where(F.col("_pair").isin([int(p) for p in boxes])).join(kth, "_rid", "left").withColumn("_bound", F.coalesce("_bound", F.lit(math.inf)))
        names, kinds = rows.columns, {f.name: f.dataType.simpleString() for f in rows.schema}

        def others(batches):
            """A row for every other block that the receiver's ball meets."""
            for batch in batches:
                pair, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_pair", "_block"))
                points = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in s_names], axis=1)
                radius = batch.column("_bound").to_numpy(zero_copy_only=False) ** 2 * batch.column("_m").to_numpy(zero_copy_only=False) / D * _MARGIN
                for at in range(0, len(pair), 1024):
                    part = slice(at, at + 1024)
                    for p in np.unique(pair[part]):
                        rows_of = at + np.flatnonzero(pair[part] == p)
                        block_ids, lo, hi = boxes[p]
                        meets = (_box_distance(points[rows_of], lo, hi) <= radius[rows_of, None]) & (block_ids[None, :] != own[rows_of, None])
                        row, which = np.nonzero(meets)
                        out = batch.take(pa.array(rows_of[row]))
                        yield out.set_column(names.index("_block"), "_block", pa.array(block_ids[which].astype(np.int64)))

        wider = materialize(rows.mapInArrow(others, ", ".join(f"{c} {kinds[c]}" for c in names)), "knn-wider")
        found = found.unionByName(_searched(wider, d_all, s_names, D, k, leaf, block, tasks))
    # back to receivers, merge pairs, keep k nearest, weighted mean
    cand = r_all.join(r_pts.select("_rid", *key_cols), key_cols).select("_t", "_id", "_rid").join(found, "_rid")
    wid = Window.partitionBy("_t", "_id").orderBy("_dist", "_did")
    best = cand.withColumn("_rn", F.row_number().over(wid)).where(F.col("_rn") <= k)
    agg = best.groupBy("_t", "_id").agg(
        F.count_if(F.col("_dist") == 0).alias("_nz"),
        F.avg(F.when(F.col("_dist") == 0, F.col("_v"))).alias("_zero_mean"),
        F.sum(F.when(F.col("_dist") > 0, F.col("_v") / F.col("_dist"))).alias("_num"),
        F.sum(F.when(F.col("_dist") > 0, F.lit(1.0) / F.col("_dist"))).alias("_den"))
    val = F.when(F.col("_nz") > 0, F.col("_zero_mean")).otherwise(F.col("_num") / F.col("_den"))
    found = agg.select("_t", "_id", val.alias("_value"))
    all_r = recv_all.join(found, ["_t", "_id"], "left")
    return all_r.select("_t", "_id", F.coalesce(F.col("_value"), means[F.col("_t")]).alias("_value"))
