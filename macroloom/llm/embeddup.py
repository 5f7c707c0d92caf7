"""Near-duplicate embeddings: every pair of vectors of a label is compared, tile by tile."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.llm.common import stored
from macroloom.llm.components import components

#: Least cosine of a link.
THRESHOLD = 0.98
#: Share of links that are found: no pair of a label goes uncompared.
RECALL = 1.0
#: Vectors of the one block of a small label; blocks grow with the square root of the label from there.
BLOCK = 256
#: Numbers that the vectors of a block have together, and cosines that are held at once, at most (in expectation).
NUMBERS, CELLS = 1 << 21, 1 << 22


def unit_rows(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    if not len(vectors):
        return np.zeros((0, 0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def linked_pairs(rows: np.ndarray, others: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of unit rows link. Cosines in single precision decide, but for those within its error of the threshold."""
    cosine = rows.astype(np.float32) @ others.astype(np.float32).T
    linked = cosine >= threshold
    unsure = np.argwhere(np.abs(cosine - np.float32(threshold)) <= (rows.shape[1] + 8) * 2.0**-23)
    for i in range(0, len(unsure), 1 << 16):
        a, b = unsure[i : i + (1 << 16)].T
        linked[a, b] = np.einsum("nd,nd->n", rows[a], others[b]) >= threshold
    return linked


def tile_links(tile: pa.Table, threshold: float) -> pa.Table:
    """(i, j, block, rep, copies, vec) of two blocks i, j, or of one against itself, to (rep, n, root) of vectors that link.

    ``n`` counts the links between the blocks, repeated vectors each; ``root`` is the least id that
    these links lead to, so that a tile of n vectors gives n rows, however many pairs link.
    """
    tile = tile.combine_chunks()
    i, j = tile.column("i")[0].as_py(), tile.column("j")[0].as_py()
    block, ids, copies = (tile.column(c).to_numpy() for c in ("block", "rep", "copies"))
    rows = unit_rows(tile.column("vec").combine_chunks())
    one, other = np.flatnonzero(block == i), np.flatnonzero(block == j)
    roots, counts, weights = ids.copy(), np.zeros(len(ids)), copies.astype(np.float64)
    step = max(1, CELLS // max(1, len(other)))
    for start in range(0, len(one), step):
        part = one[start : start + step]
        linked = linked_pairs(rows[part], rows[other], threshold)
        linked &= ids[part][:, None] != ids[other][None, :]
        some = np.flatnonzero(linked.any(1))
        part, linked = part[some], linked[some]
        counts[part] += linked @ weights[other]
        if i != j:
            counts[other] += weights[part] @ linked
        for at, row in zip(part.tolist(), linked):
            met = roots[other[row]]
            if (met != roots[at]).any():
                met = np.unique(np.append(met, roots[at]))
                roots[np.isin(roots, met)] = met[0]
    found = np.flatnonzero(counts > 0)
    return pa.table({"rep": pa.array(ids[found], pa.int64()), "n": pa.array(counts[found].astype(np.int64)), "root": pa.array(roots[found], pa.int64())})


def near_duplicate_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", threshold: float = THRESHOLD
) -> tuple[DataFrame, float]:
    """((id, n_links, component_id, kept) of every row, RECALL).

    Vectors of equal label and length link when the cosine of their angle, in double precision, is at
    least ``threshold``. ``component_id`` is the least id that links lead to; only it is kept.

    Equal vectors of a label are one to begin with. The vectors of a label and length are dealt into
    blocks, and every block meets every other and itself in a task of its own, so that no pair is
    left out. A task counts the links of each vector and joins what links; components come from
    these joins. Only the counts and one id a vector leave a task.

    Rows with a null id or label, a null, empty or zero vector, or a null or non-finite component
    link with nothing; a null id has a null ``component_id`` and is kept. Repeated rows count as
    vectors that link; different vectors under one id share their links. Other columns are ignored.
    Ids and labels are whole numbers.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), F.col(vector_column).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    reps = rows.where("sound").groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    reps = stored(reps.select("rep", "label", "copies", "vec"), "embeddup-vectors")
    lengths = reps.withColumn("dim", F.size("vec"))
    sizes = lengths.groupBy("label", "dim").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.greatest(F.sqrt(F.col("size") / BLOCK), F.col("size") * F.col("dim") / NUMBERS))
    dealt = lengths.join(sizes.select("label", "dim", blocks.alias("blocks")), ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("vec"), "blocks"))
    facing = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("facing"))
    tiles = facing.select("label", "dim", F.least("block", "facing").alias("i"), F.greatest("block", "facing").alias("j"), "block", "rep", "copies", "vec")
    links = tiles.groupBy("label", "dim", "i", "j").applyInArrow(lambda tile: tile_links(tile, threshold), "rep long, n long, root long")
    links = stored(links, "embeddup-links")
    classes = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    counted = links.groupBy("rep").agg(F.sum("n").alias("n"))
    placed = reps.join(classes, "rep", "left").join(counted, "rep", "left")
    named = placed.select("label", "vec", F.coalesce("component", "rep").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = rows.where("sound").join(named, ["label", "vec"]).select("id", "n_links", "component")
    alone = rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    out = joined.union(alone).select(
        F.col("id").alias(id_column), "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept")
    )
    return out, RECALL
