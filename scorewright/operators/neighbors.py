"""Exact k nearest neighbours in pruned blocks, the k-NN classifier, and SMOTE.

1. Reference rows are dealt to cells: quantile bins on the top principal axes W, so an
   outlier does not push the rest into one cell.  The number of cells follows the
   counted rows.  A cell of more than ``BLOCK_ROWS`` rows is cut into blocks by hash.
2. ``P`` pivots are reference rows picked by a seeded hash (a top-P, bounded).  The k-th
   nearest pivot gives an upper bound ``ub`` on a query's k-th neighbour distance.
3. Since ||W'(q - x)|| <= ||q - x||, the distance from W'q to the bounding box of a cell
   is a lower bound for every row of it.  Cells that lie together form groups of at most a
   block's rows, about ``GROUPS`` of them; a query is sent once to each group with a cell
   whose bound is <= ub, so what is sent follows the groups and not the many small cells.
4. Queries and reference rows of a block meet in one task, ``QUERY_ROWS`` queries at
   most; a matrix product per slice of queries finds near rows, the exact distances of
   those are computed, and k per query and block leave the task.
5. A window per query merges them (ties by id).

Every step is exact, so the result equals brute force; pruning only removes rows that
provably cannot be among the k nearest.  Rows without a vector are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranks import hash_key, hashed_rank

SEED = 42
CELL_ROWS = 32          # reference rows a cell aims at, up to ``max_cells`` cells
GROUPS = 64             # groups of cells, more where one would hold over a block
BLOCK_ROWS = 16_384     # reference rows that a task holds at once, about
QUERY_ROWS = 262_144    # queries that meet a block in one task, about
SLICE = 1 << 21         # distances in a matrix product


def _pivots(ref: DataFrame, key: str, vec: str, n_pivots: int):
    rows = (ref.select(key, vec).orderBy(hash_key(F.col(key), SEED), key).limit(n_pivots).collect())
    ids = np.array([r[key] for r in rows])
    mat = np.array([r[vec] for r in rows], dtype="float64")
    return ids, mat


def _principal_axes(ref_v: DataFrame, dims: int) -> np.ndarray:
    """Top principal axes of the reference vectors (d x dims, orthonormal columns).

    Spark ML PCA: a distributed covariance (d x d on the driver; d is the vector
    width, not the row count)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    width = len(ref_v.select("_v").first()["_v"])
    dims = max(1, min(dims, width))
    model = PCA(k=dims, inputCol="_vv", outputCol="_pz").fit(ref_v.select(array_to_vector("_v").alias("_vv")))
    return model.pc.toArray()


def _squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by a matrix product, and a bound of their rounding error per row of x."""
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    error = 1e-14 * max(x.shape[1], 1) * (xx + (yy.max() if len(yy) else 0.0))
    return np.maximum(xx[:, None] + yy[None, :] - 2 * (x @ y.T), 0.0), error


def _nearest(q_id, q, ub, n_id, ref, k: int, exclude_self: bool):
    """Positions (query, reference) and distances of the k nearest of each query, within ub."""
    d2, error = _squares(q, ref)
    if exclude_self:
        d2[q_id[:, None] == n_id[None, :]] = np.inf
    limit = np.minimum(np.partition(d2, k - 1, axis=1)[:, k - 1] if d2.shape[1] > k else np.inf, ub * ub)
    i, j = np.nonzero((d2 <= (limit + 2 * error)[:, None]) & np.isfinite(d2))
    dist = np.sqrt(((q[i] - ref[j]) ** 2).sum(axis=1))
    near = dist <= ub[i]
    i, j, dist = i[near], j[near], dist[near]
    order = np.lexsort((n_id[j], dist, i))
    i, j, dist = i[order], j[order], dist[order]
    first = np.searchsorted(i, i)  # where the query's rows begin
    top = np.arange(len(i)) - first < k
    return i[top], j[top], dist[top]


def _cells(rz: DataFrame, m: int, cells: int):
    """Column of the cell of ``_z``: bits dealt to the axes in turn, bins between quantiles.
    The first axis counts most, so cells with near numbers lie together."""
    bits = max(0, cells.bit_length() - 1)
    per_axis = [1 << (bits // m + (i < bits % m)) for i in range(m)]
    cuts = rz.agg(*[F.percentile_approx(F.col("_z")[i], [(j + 1) / g for j in range(g - 1)] or [0.5], 1000).alias(f"c{i}")
                    for i, g in enumerate(per_axis)]).first()
    cell, base = F.lit(0), 1
    for i, g in reversed(list(enumerate(per_axis))):
        for cut in sorted(set(cuts[f"c{i}"])) if g > 1 else []:
            cell = cell + F.when(F.col("_z")[i] > F.lit(float(cut)), F.lit(base)).otherwise(F.lit(0))
        base *= g
    return cell.cast("int")


def _groups(sizes: Sequence[int]) -> np.ndarray:
    """Group of each cell, the cells in order: runs of cells with about the same number of rows."""
    target = min(BLOCK_ROWS, max(CELL_ROWS, -(-sum(sizes) // GROUPS)))
    out, held, group = np.zeros(len(sizes), dtype="int32"), 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > target:
            held, group = 0, group + 1
        out[i], held = group, held + n
    return out


def knn(query: DataFrame, ref: DataFrame, k: int, *, key: str = "id", vec: str = "v",
        ref_key: str | None = None, exclude_self: bool = True, n_pivots: int = 256,
        proj_dims: int = 4, max_cells: int = 4096, diagnostics: dict | None = None) -> DataFrame:
    """(q_id, n_id, rank, distance) for the k nearest reference rows of every query row.

    ``vec`` holds array<double>.  With ``exclude_self`` a row is not its own
    neighbour (same key).  Ids are numbers or strings."""
    ref_key = ref_key or key
    rv = ref.select(F.col(ref_key).alias("_id"), F.col(vec).alias("_v")).where("_id is not null and _v is not null")
    qv = query.select(F.col(key).alias("_id"), F.col(vec).alias("_v")).where("_id is not null and _v is not null")
    id_type = rv.schema["_id"].dataType.simpleString()
    n_ref, n_query = rv.count(), qv.count()
    if not n_ref or not n_query:
        return query.sparkSession.createDataFrame([], f"q_id {id_type}, n_id {id_type}, rank int, distance double")
    piv_ids, piv = _pivots(rv, "_id", "_v", n_pivots)
    axes = _principal_axes(rv, proj_dims)
    m = axes.shape[1]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(v: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(v.to_numpy()).astype("float64") @ axes))

    rz = rv.withColumn("_z", project("_v"))
    rz = rz.withColumn("_cell", _cells(rz, m, min(max_cells, -(-n_ref // CELL_ROWS))))
    # one row per non-empty cell (at most max_cells): size, and bounding box of its projected rows
    boxes = rz.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"),
                                    *[F.min(F.col("_z")[i]).alias(f"a{i}") for i in range(m)],
                                    *[F.max(F.col("_z")[i]).alias(f"b{i}") for i in range(m)]).orderBy("_cell").collect()
    group_of = _groups([r["n"] for r in boxes])
    group_ids, first_cells = np.unique(group_of, return_index=True)
    box_lo = np.array([[r[f"a{i}"] for i in range(m)] for r in boxes])
    box_hi = np.array([[r[f"b{i}"] for i in range(m)] for r in boxes])
    rows_of = np.add.reduceat([r["n"] for r in boxes], first_cells)
    # from here on ``_cell`` is a group of cells; both tables have at most max_cells rows
    spark = query.sparkSession
    group = spark.createDataFrame([(r["_cell"], int(g)) for r, g in zip(boxes, group_of)], "_cell int, _group int")
    rz = rz.join(F.broadcast(group), "_cell").drop("_cell").withColumnRenamed("_group", "_cell")
    parts = spark.createDataFrame(
        [(int(g), int(-(-n // BLOCK_ROWS)), int(n)) for g, n in zip(group_ids, rows_of)], "_cell int, _parts int, _n long")

    @F.pandas_udf(T.StructType([T.StructField("ub", T.DoubleType()),
                                T.StructField("cand", T.ArrayType(T.IntegerType()))]))
    def candidates(qid: pd.Series, v: pd.Series) -> pd.DataFrame:
        vectors, ids = v.to_numpy(), qid.to_numpy()
        step = max(1, SLICE // max(len(group_of), len(piv_ids)))
        ubs, cands = [], []
        for at in range(0, len(vectors), step):
            x = np.stack(vectors[at:at + step]).astype("float64")
            d2, error = _squares(x, piv)
            if exclude_self:
                d2[piv_ids[None, :] == ids[at:at + step, None]] = np.inf
            kth = np.partition(d2, k - 1, axis=1)[:, k - 1] if d2.shape[1] >= k else np.full(len(x), np.inf)
            # relaxed: products and differences may differ in the last bits
            ub = np.sqrt(kth + error) * (1 + 1e-9) + 1e-12
            z, lb = x @ axes, np.zeros((len(x), len(group_of)))
            for i in range(m):
                gap = np.maximum(box_lo[None, :, i] - z[:, None, i], z[:, None, i] - box_hi[None, :, i])
                lb += np.maximum(gap, 0.0) ** 2
            near = np.sqrt(lb) <= (ub + np.sqrt(error) * 1e-3)[:, None]
            cands += [group_ids[row] for row in np.logical_or.reduceat(near, first_cells, axis=1)]
            ubs.append(ub)
        return pd.DataFrame({"ub": np.concatenate(ubs) if ubs else np.zeros(0), "cand": cands})

    q = qv.withColumn("_c", candidates("_id", "_v")).select("_id", "_v", "_c.ub", F.explode("_c.cand").alias("_cell"))
    if diagnostics is not None:   # candidate pairs after pruning (an extra job; diagnostics only)
        diagnostics["sent"], diagnostics["candidate_pairs"] = q.join(F.broadcast(parts), "_cell").agg(F.count("*"), F.sum("_n")).first()
    return _meet_in_blocks(rz, q, parts, n_query, k, exclude_self)


def _meet_in_blocks(rz: DataFrame, q: DataFrame, parts: DataFrame, n_query: int, k: int, exclude_self: bool) -> DataFrame:
    """The k nearest of each query (_id, _v, ub, _cell; a row for each cell it visits) among the
    reference rows (_id, _v, _cell) of those cells, within ``ub``.  ``parts`` has one row a
    cell: its number of blocks.  A task meets one block with a slice of the queries."""
    id_type = rz.schema["_id"].dataType.simpleString()
    result = f"q_id {id_type}, n_id {id_type}, distance double"
    q = q.join(F.broadcast(parts), "_cell")
    salts = -(-n_query // QUERY_ROWS)
    salt = F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    q = q.withColumn("_part", spread(F.col("_parts"))).select("_cell", "_part", salt.alias("_salt"), F.lit(1).alias("_kind"), "_id", "_v", "ub")
    r = rz.join(F.broadcast(parts), "_cell").withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("_parts")).cast("int")) \
        .withColumn("_salt", spread(F.lit(salts))) \
        .select("_cell", "_part", "_salt", F.lit(0).alias("_kind"), "_id", "_v", F.lit(None).cast("double").alias("ub"))
    unit = ["_cell", "_part", "_salt"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vectors, n_id, mat = None, [], [], None, None
        for batch in batches:
            kind = batch.column(3).to_numpy()
            units = np.stack([batch.column(c).to_numpy() for c in range(3)])
            edge = np.flatnonzero(np.concatenate([[True], (units[:, 1:] != units[:, :-1]).any(axis=0) | (kind[1:] != kind[:-1])])) \
                if len(kind) else []
            for lo, hi in zip(edge, [*edge[1:], len(kind)]):
                own = tuple(units[:, lo])
                if own != now:
                    now, ids, vectors, mat = own, [], [], None
                x = batch.column(5).slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).reshape(hi - lo, -1)
                x_id = batch.column(4).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                if kind[lo] == 0:
                    ids.append(x_id)
                    vectors.append(x)
                    continue
                if not ids:
                    continue
                if mat is None:
                    n_id, mat = np.concatenate(ids), np.concatenate(vectors)
                ub = batch.column(6).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                step = max(1, SLICE // len(mat))
                for at in range(0, len(x), step):
                    to = at + step
                    i, j, dist = _nearest(x_id[at:to], x[at:to], ub[at:to], n_id, mat, k, exclude_self)
                    kind_of = batch.schema.field(4).type
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x_id[at:to][i], kind_of), pa.array(n_id[j], kind_of), pa.array(dist, pa.float64())],
                        ["q_id", "n_id", "distance"])

    dealt = r.unionByName(q).repartition(*unit).sortWithinPartitions(*unit, "_kind")
    found = dealt.mapInArrow(meet, result)
    w = Window.partitionBy("q_id").orderBy("distance", "n_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("q_id", "n_id", F.col("rank").cast("int").alias("rank"), "distance"))


def knn_approx(query: DataFrame, ref: DataFrame, k: int, *, key: str = "id", vec: str = "v", ref_key: str | None = None,
               exclude_self: bool = True, probes: int = 8, cell_rows: int = 256, max_cells: int = 4096, sample: int = 50_000) -> DataFrame:
    """(q_id, n_id, rank, distance) like ``knn``, with neighbours looked for in ``probes`` cells only.

    The cells are those of k-means centres, fitted on at most ``sample`` reference rows in
    hash order; every reference row is indexed, in the cell of its nearest centre, and a
    query visits the cells of its ``probes`` nearest centres.  Cells of any size are cut into
    blocks, and distances are exact, so what is missed is a neighbour in a cell that is not
    visited: with as many probes as cells the result is that of ``knn``.  Each query is sent
    ``probes`` times, whatever the data, where the exact join may need every cell."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    ref_key = ref_key or key
    rv = ref.select(F.col(ref_key).alias("_id"), F.col(vec).alias("_v")).where("_id is not null and _v is not null")
    qv = query.select(F.col(key).alias("_id"), F.col(vec).alias("_v")).where("_id is not null and _v is not null")
    id_type = rv.schema["_id"].dataType.simpleString()
    n_ref, n_query = rv.count(), qv.count()
    if not n_ref or not n_query:
        return query.sparkSession.createDataFrame([], f"q_id {id_type}, n_id {id_type}, rank int, distance double")
    cells = max(1, min(max_cells, n_ref // cell_rows))
    fitted_on = rv.orderBy(hash_key(F.col("_id"), SEED), "_id").limit(sample).select(array_to_vector("_v").alias("features"))
    centres = np.array(KMeans(k=cells, seed=SEED, maxIter=10).fit(fitted_on).clusterCenters()) if cells > 1 else \
        np.zeros((1, len(rv.first()["_v"])))
    probes = min(probes, len(centres))

    def nearest_centres(n: int):
        @F.pandas_udf(T.ArrayType(T.IntegerType()))
        def of(v: pd.Series) -> pd.Series:
            vectors, out = v.to_numpy(), []
            step = max(1, SLICE // len(centres))
            for at in range(0, len(vectors), step):
                d2, _ = _squares(np.stack(vectors[at:at + step]).astype("float64"), centres)
                out += list(np.argsort(d2, axis=1, kind="stable")[:, :n].astype("int32"))
            return pd.Series(out)
        return of

    rz = rv.withColumn("_cell", nearest_centres(1)("_v")[0])
    parts = rz.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).select("_cell", F.ceil(F.col("_n") / BLOCK_ROWS).cast("int").alias("_parts"), "_n")
    q = qv.withColumn("ub", F.lit(float("inf"))).withColumn("_cell", F.explode(nearest_centres(probes)("_v")))
    return _meet_in_blocks(rz, q, parts, n_query, k, exclude_self)


def knn_classify(train: DataFrame, test: DataFrame, k: int = 5, *, key: str = "id", vec: str = "v",
                 label: str = "label", weights: str = "uniform") -> DataFrame:
    """k-NN vote: share of positive neighbours (``distance`` weights use 1/d;
    a zero distance takes the vote alone, as scikit-learn does)."""
    nn = knn(test, train, k, key=key, vec=vec, exclude_self=False)
    lab = train.select(F.col(key).alias("n_id"), F.col(label).alias("_y"))
    j = nn.join(lab, "n_id")
    if weights == "distance":
        zero = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("q_id"))
        wgt = F.when(zero == 1, (F.col("distance") == 0).cast("double")).otherwise(1.0 / F.col("distance"))
        j = j.withColumn("_w", wgt)
    else:
        j = j.withColumn("_w", F.lit(1.0))
    p1 = F.sum(F.col("_w") * F.col("_y")) / F.sum("_w")
    out = j.groupBy(F.col("q_id").alias(key)).agg(p1.alias("p1"))
    return out.withColumn("prediction", (F.col("p1") > 0.5).cast("int"))


def knn_settings(train: DataFrame, test: DataFrame, ks: Sequence[int], *, key: str = "id", vec: str = "v", label: str = "label") -> DataFrame:
    """(k, weights, id, p1) of each test row for every k and both weightings of ``knn_classify``.

    One neighbour join at the largest k holds the answers of all smaller ones: a setting is a
    condition on the neighbour's rank and a weight, so all are aggregates of one grouping."""
    nn = knn(test, train, max(ks), key=key, vec=vec, exclude_self=False)
    near = nn.join(train.select(F.col(key).alias("n_id"), F.col(label).alias("_y")), "n_id")
    sums = []
    for k in ks:
        inside, zero = F.col("rank") <= k, F.col("distance") == 0
        inverse = F.when(inside & ~zero, 1.0 / F.col("distance")).otherwise(0.0)
        y, n0 = F.col("_y"), F.count_if(inside & zero)
        even = F.sum(F.when(inside, y)) / F.count_if(inside)
        by_distance = F.when(n0 > 0, F.sum(F.when(inside & zero, y)) / n0).otherwise(F.sum(inverse * y) / F.sum(inverse))
        sums += [F.struct(F.lit(k).alias("k"), F.lit(name).alias("weights"), p.cast("double").alias("p1"))
                 for name, p in (("uniform", even), ("distance", by_distance))]
    out = near.groupBy(F.col("q_id").alias(key)).agg(F.array(*sums).alias("_s"))
    return out.select(key, F.explode("_s").alias("_s")).select("_s.k", "_s.weights", key, "_s.p1")


def smote(df: DataFrame, *, key: str = "id", vec: str = "v", label: str = "label", k: int = 3,
          seed: int = SEED, n_pivots: int = 32) -> DataFrame:
    """Raise the minority class to the majority count with synthetic rows
    x + u * (neighbour - x), neighbour among the k nearest minority rows.

    Deterministic: minority row j makes floor(n_new / n_min) rows, plus one for
    the first n_new mod n_min rows in hash order; the neighbour index and ``u``
    come from seeded hashes of (key, copy).  Synthetic keys are negative."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    minority = min(counts, key=lambda c: (counts[c], c))
    majority = max(counts, key=lambda c: (counts[c], -c))
    n_min, n_new = counts[minority], counts[majority] - counts[minority]
    if n_new <= 0 or n_min < 2:
        return df.select(key, vec, label).withColumn("synthetic", F.lit(0))
    mino = df.where(F.col(label) == minority).select(key, vec)
    nn = knn(mino, mino, min(k, n_min - 1), key=key, vec=vec, n_pivots=n_pivots)
    base, extra = divmod(n_new, n_min)
    # exact rank in hash order, computed bucket-wise (no single-task window)
    ranked = hashed_rank(mino, [], hash_key(F.col(key), seed), F.col(key), size_col=None)
    reps = ranked.withColumn(
        "_m", F.lit(base) + (F.col("_rank") < F.lit(extra)).cast("int"))
    copies = reps.where(F.col("_m") > 0).withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    kk = min(k, n_min - 1)
    tag = F.concat(F.col(key).cast("string"), F.lit(":"), F.col("_t").cast("string"))
    copies = copies.withColumn("rank", (F.pmod(hash_key(tag, seed + 1), F.lit(kk)) + 1).cast("int")) \
        .withColumn("_u", hash_key(tag, seed + 2).cast("double") / F.lit(float(2 ** 60)))
    pick = copies.join(nn.select(F.col("q_id").alias(key), "rank", "n_id"), [key, "rank"])
    nbr = mino.select(F.col(key).alias("n_id"), F.col(vec).alias("_nv"))
    syn = pick.join(nbr, "n_id").select(
        (-(F.col("_rank") * F.lit(n_new + 1) + F.col("_t") + 1)).cast("long").alias(key),
        F.zip_with(F.col(vec), F.col("_nv"), lambda x, y: x + F.col("_u") * (y - x)).alias(vec),
        F.lit(minority).alias(label), F.lit(1).alias("synthetic"))
    orig = df.select(key, vec, label).withColumn("synthetic", F.lit(0))
    return orig.unionByName(syn)
