"""Hard negatives: R-trees packed by sort-tile-recursive, searched best box first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macroloom.llm.common import stored

#: Numbers that the vectors of a tile have together, and those of a block of anchors (in expectation).
TILE, BLOCK = 1 << 19, 1 << 18
#: Boxes of tiles that a block of anchors meets at a time.
PAGE = 4096
#: Vectors of a leaf, and children of an inner node.
LEAF, FANOUT = 32, 8
#: Pairs of a task that wait to be reduced to the best of each anchor.
WAITING = 1 << 20


def str_order(rows: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Order of rows in which runs of ``leaf`` are tiles: sort by a coordinate, cut into slabs, go on with the next in each.

    The label is the first coordinate, the others follow by their spread.
    """
    columns = np.column_stack([labels.astype(np.float64), rows[:, np.argsort(-np.ptp(rows, axis=0), kind="stable")]])

    def tile(some: np.ndarray, depth: int) -> list[np.ndarray]:
        tiles = -(-len(some) // leaf)
        if tiles <= 1 or depth == columns.shape[1]:
            return [some]
        some = some[np.argsort(columns[some, depth], kind="stable")]
        slabs = math.ceil(tiles ** (1 / (columns.shape[1] - depth)))
        size = -(-tiles // slabs) * leaf
        return [t for i in range(0, len(some), size) for t in tile(some[i : i + size], depth + 1)]

    return np.concatenate(tile(np.arange(len(rows)), 0)) if len(rows) else np.zeros(0, np.int64)


class Tree:
    """Vectors in packed order, and the boxes of leaves, of FANOUT leaves each, and so on up to one root."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        self.order = str_order(rows, labels)
        self.rows, self.labels = rows[self.order], labels[self.order]
        self.levels = []
        low, high, first, last, width = self.rows, self.rows, self.labels, self.labels, LEAF
        while True:
            cuts = np.arange(0, len(low), width)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            first, last = np.minimum.reduceat(first, cuts), np.maximum.reduceat(last, cuts)
            self.levels.append((low, high, first, last))
            if len(cuts) == 1:
                break
            width = FANOUT


def intervals(asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each vector with any vector of each box."""
    plus, minus = np.maximum(asked, 0), np.minimum(asked, 0)
    return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


class Best:
    """The ``most`` best entries (score falling, then id, then key) of every window of every anchor."""

    def __init__(self, lows: np.ndarray, highs: np.ndarray, most: int):
        self.floor, self.highs, self.most = lows.copy(), highs, most
        self.scores = np.full((*lows.shape, most), -np.inf)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def wants(self, who: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
        """Which anchors may find something in boxes of these intervals (anchor, box): not those whose
        windows lie outside, nor those that have ``most`` better ones."""
        out = np.zeros(least.shape, bool)
        for w in range(self.floor.shape[1]):
            out |= (greatest >= self.floor[who, w, None]) & (least <= self.highs[who, w, None])
        return out

    def add(self, who: np.ndarray, scores: np.ndarray, allowed: np.ndarray, rows: np.ndarray) -> None:
        """Scores (anchor, row) of a leaf, where allowed."""
        for w in range(self.floor.shape[1]):
            inside = allowed & (scores >= self.floor[who, w, None]) & (scores <= self.highs[who, w, None])
            some = np.flatnonzero(inside.any(1))
            if not len(some):
                continue
            at, row = np.nonzero(inside[some])
            self.waiting.append((who[some][at], np.full(len(at), w), scores[some][at, row], rows[row]))
            self.held += len(at)
            all_scores = np.concatenate([self.scores[who[some], w], np.where(inside[some], scores[some], -np.inf)], 1)
            best = np.partition(all_scores, all_scores.shape[1] - self.most, 1)[:, -self.most :]
            self.scores[who[some], w] = best
            self.floor[who[some], w] = np.maximum(self.floor[who[some], w], best.min(1))

    def entries(self, first: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(anchor, window, score, id, key, row) of the best so far; ``first`` has the starts, ids and keys of rows' entries."""
        if not self.waiting:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.int64, np.int64, np.int64))
        who, window, score, row = (np.concatenate(x) for x in zip(*self.waiting))
        starts, ids, keys = first
        keep = score >= self.floor[who, window]
        who, window, score, row = who[keep], window[keep], score[keep], row[keep]
        many = starts[row + 1] - starts[row]
        at = np.repeat(starts[row] - np.cumsum(many) + many, many) + np.arange(many.sum())
        who, window, score, row = (np.repeat(x, many) for x in (who, window, score, row))
        order = np.lexsort((keys[at], ids[at], -score, window, who))
        who, window, score, row, at = (x[order] for x in (who, window, score, row, at))
        new = np.flatnonzero(np.concatenate(([True], (who[1:] != who[:-1]) | (window[1:] != window[:-1])))) if len(who) else np.zeros(0, np.int64)
        nth = np.arange(len(who)) - np.repeat(new, np.diff(np.append(new, len(who))))
        keep = nth < self.most
        return tuple(x[keep] for x in (who, window, score, ids[at], keys[at], row))

    def reduce(self, first: list[np.ndarray]) -> None:
        who, window, score, _, _, row = self.entries(first)
        pairs = np.unique(np.stack([who, window, row]), axis=1, return_index=True)[1]
        self.waiting, self.held = [(who[pairs], window[pairs], score[pairs], row[pairs])], len(pairs)


def search(tree: Tree, first: list[np.ndarray], asked: np.ndarray, labels: np.ndarray, best: Best, same: bool) -> None:
    """Fills ``best`` from the tree, with rows of the anchors' own labels or of others.

    One queue serves all anchors of a block: the box that promises the greatest product to any of
    them comes first, and each box is opened only for the anchors that still want it then.
    """
    top = len(tree.levels) - 1
    queue: list[tuple] = []
    tie = 0

    def push(level: int, nodes: np.ndarray, who: np.ndarray) -> None:
        nonlocal tie
        low, high, lowest, highest = (x[nodes] for x in tree.levels[level])
        least, greatest = intervals(asked[who], low, high)
        own = labels[who, None]
        fits = (lowest <= own) & (own <= highest) if same else (lowest != own) | (own != highest)
        wanted = fits & best.wants(who, least, greatest)
        for c in np.flatnonzero(wanted.any(0)):
            some = wanted[:, c]
            tie += 1
            heapq.heappush(queue, (-greatest[some, c].max(), tie, level, nodes[c], who[some], least[some, c], greatest[some, c]))

    push(top, np.arange(1), np.arange(len(asked)))
    while queue:
        _, _, level, node, who, least, greatest = heapq.heappop(queue)
        who = who[best.wants(who, least[:, None], greatest[:, None])[:, 0]]
        if not len(who):
            continue
        if level:
            push(level - 1, np.arange(node * FANOUT, min((node + 1) * FANOUT, len(tree.levels[level - 1][0]))), who)
            continue
        rows = np.arange(node * LEAF, min((node + 1) * LEAF, len(tree.rows)))
        alike = labels[who, None] == tree.labels[None, rows]
        best.add(who, asked[who] @ tree.rows[rows].T, alike if same else ~alike, tree.order[rows])
        if best.held > WAITING:
            best.reduce(first)


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _windows(asked: pa.Table) -> tuple[np.ndarray, ...]:
    """lows, highs and marks as rectangles; places that are filled up hold no score."""
    lists = [asked.column(c).to_pylist() for c in ("lows", "highs", "marks")]
    width = max([len(x) for x in lists[0]], default=0)
    return tuple(np.array([x + [fill] * (width - len(x)) for x in some], np.float64).reshape(len(some), width) for some, fill in zip(lists, (np.inf, -np.inf, 0.0)))


def search_tile(tile: pa.Table, asked: pa.Table, most: int, same: bool) -> pa.Table:
    """Vectors of a tile (label, vec, first) and anchors (rep, label, vec, lows, highs, marks) to (rep, mark, score, id, key)."""
    names = {"rep": pa.int64(), "mark": pa.float64(), "score": pa.float64(), "id": pa.int64(), "key": pa.int64()}
    if not len(tile) or not len(asked):
        return pa.table({n: pa.array([], t) for n, t in names.items()})
    rows, labels = _matrix(tile.column("vec"), len(tile)), tile.column("label").to_numpy()
    entries = tile.column("first").combine_chunks()
    many = np.array([len(x) for x in entries])
    flat = entries.flatten()
    first = [np.concatenate(([0], np.cumsum(many))), flat.field("id").to_numpy(zero_copy_only=False), flat.field("key").to_numpy(zero_copy_only=False)]
    lows, highs, marks = _windows(asked)
    best = Best(lows, highs, most)
    search(Tree(rows, labels), first, _matrix(asked.column("vec"), len(asked)), asked.column("label").to_numpy(), best, same)
    who, window, score, ids, keys, _ = best.entries(first)
    return pa.table([pa.array(asked.column("rep").to_numpy()[who]), pa.array(marks[who, window]), pa.array(score), pa.array(ids), pa.array(keys)], names=list(names))


def box_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tile, dim, label, vec) to the boxes (tile, dim, first, last, low, high) of each batch's part of its tiles."""
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        tiles, dims = (table.column(c).to_numpy() for c in ("tile", "dim"))
        out = []
        for tile, dim in sorted(set(zip(tiles.tolist(), dims.tolist()))):
            part = table.filter(pa.array((tiles == tile) & (dims == dim)))
            rows, labels = _matrix(part.column("vec"), len(part)), part.column("label").to_numpy()
            out.append((tile, dim, int(labels.min()), int(labels.max()), rows.min(0).tolist(), rows.max(0).tolist()))
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["tile", "dim", "first", "last", "low", "high"])


def wanted_tiles(boxes: pa.Table, asked: pa.Table, same: bool) -> pa.Table:
    """Boxes of tiles and the anchors of one block to the (block, tile, dim) that any of them has to search."""
    if not len(boxes) or not len(asked):
        return pa.table({"block": pa.array([], pa.int32()), "tile": pa.array([], pa.int32()), "dim": pa.array([], pa.int32())})
    lows, highs, _ = _windows(asked)
    least, greatest = intervals(_matrix(asked.column("vec"), len(asked)), _matrix(boxes.column("low"), len(boxes)), _matrix(boxes.column("high"), len(boxes)))
    own, first, last = asked.column("label").to_numpy()[:, None], boxes.column("first").to_numpy(), boxes.column("last").to_numpy()
    fits = (first <= own) & (own <= last) if same else (first != own) | (own != last)
    wanted = fits & Best(lows, highs, 1).wants(np.arange(len(asked)), least, greatest)
    some = np.unique(boxes.column("tile").to_numpy()[wanted.any(0)])
    block, dim = asked.column("block")[0].as_py(), asked.column("dim")[0].as_py()
    return pa.table({"block": pa.array([block] * len(some), pa.int32()), "tile": pa.array(some, pa.int32()), "dim": pa.array([dim] * len(some), pa.int32())})


FOUND = "rep long, mark double, score double, id long, key long"


def _best_of(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best of each anchor and mark over all tiles, numbered from 1."""
    order = Window.partitionBy("rep", "mark").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)


def _dealt(df: DataFrame, parts: int, columns: list, name: str) -> DataFrame:
    """Rows in ``parts`` ranges of the columns at most, each with the number of its range; stored.

    Where a session deals rows into more ranges than asked for, neighbouring ones are one.
    """
    dealt = stored(df.repartitionByRange(parts, *columns).withColumn("__part", F.spark_partition_id()), f"negatives-{name}")
    ranges = max(parts, (dealt.agg(F.max("__part")).first()[0] or 0) + 1)
    return dealt.withColumn(name, F.expr(f"cast(__part * bigint({parts}) div {ranges} as int)")).drop("__part")


def _search_all(tiles: DataFrame, boxes: DataFrame, pages: int, asked: DataFrame, blocks: int, most: int, same: bool) -> DataFrame:
    """The ``most`` best of each anchor and window: blocks of anchors against the tiles whose boxes one of their windows meets."""
    on = ["block", "page", "dim"]
    facing = asked.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    paged = boxes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    wanted = paged.groupBy(*on).cogroup(facing.groupBy(*on)).applyInArrow(lambda b, a: wanted_tiles(b, a, same), "block int, tile int, dim int")
    wanted = stored(wanted.distinct(), "negatives-wanted")
    on = ["tile", "block", "dim"]
    left = tiles.join(wanted, ["tile", "dim"]).select(*on, "label", "vec", "first")
    right = asked.drop("tile").join(wanted, ["block", "dim"]).select(*on, "rep", "label", "vec", "lows", "highs", "marks")
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(lambda t, a: search_tile(t, a, most, same), FOUND)
    return _best_of(found, most)


def mine_negatives(
    vectors: DataFrame,
    anchor: Column | str,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` marks.

    Components count as whole numbers, floor(``scale`` * x), and a score is the inner product with
    the anchor, exact below 2^53. Higher scores come first, then smaller ids. Positives are an
    anchor's ``positives`` best other rows of its label; for each, its negatives are the
    ``negatives`` best rows of other labels that score ``low`` to ``high`` percent of it. Fewer rows
    where there are fewer; no row for a positive without negatives.

    Equal vectors of a label are searched as one, with the few least ids that can be in a result.
    Sort-tile-recursive packs them: ranges by label and one coordinate, in each of these ranges
    by another; ties are broken by hash, so that no value makes a tile large. Inside a
    tile the task goes on with all coordinates. A block of anchors meets the boxes of all
    tiles first, and then the tiles that a window of one of them reaches. For positives the anchor's own tile
    is searched before, so that its best there bound the rest.

    Rows with a null id or label, a null or empty vector, or a null or non-finite component take no
    part. Vectors of different length have no score. Every row counts: a second row of an anchor's
    id is another row, and repeated anchors give repeated rows. Other columns are ignored.
    """
    vec = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("vec", lambda x: F.when(F.abs(x * scale) < F.lit(2.0**53), F.floor(x * scale).cast("double")).otherwise(x * scale))
    marked = F.expr(anchor) if isinstance(anchor, str) else anchor
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), vec.alias("vec"), F.coalesce(marked, F.lit(False)).alias("anchor"))
    rows = rows.where("id is not null and label is not null and size(vec) > 0").where(finite)
    rows = rows.select("id", "label", "anchor", whole.alias("vec")).withColumn("h", F.xxhash64("label", "vec"))
    rows = stored(rows.withColumn("key", F.monotonically_increasing_id()), "negatives-rows")

    most = max(positives + 1, negatives)
    alike = Window.partitionBy("label", "h", "vec")
    first = rows.withColumn("nth", F.row_number().over(alike.orderBy("id", "key"))).where(F.col("nth") <= most)
    reps = first.groupBy("label", "h", "vec").agg(F.sort_array(F.collect_list(F.struct("id", "key"))).alias("first"))
    reps = reps.withColumn("dim", F.size("vec"))
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()), "negatives-vectors")

    spread = reps.select("dim", F.posexplode("vec")).groupBy("dim", "pos").agg(F.stddev("col").alias("by"))
    widest = F.sort_array(F.collect_list(F.struct("by", "pos")), asc=False)
    axes = spread.groupBy("dim").agg(widest.alias("axes")).select("dim", F.expr("axes[0].pos").alias("one"), F.expr("coalesce(axes[1].pos, axes[0].pos)").alias("two"))
    reps = reps.join(stored(axes, "negatives-axes"), "dim")
    tie = 1 << 20
    one = F.expr("vec[one]") + F.pmod("h", F.lit(tie)) / tie
    two = F.expr("vec[two]") + F.pmod(F.xxhash64("h"), F.lit(tie)) / tie
    parts = max(1, -(-(reps.agg(F.sum("dim")).first()[0] or 0) // TILE))
    slabs = _dealt(reps, math.isqrt(parts - 1) + 1, ["dim", "label", one], "slab")
    tiles = _dealt(slabs, parts, ["slab", "dim", two, "rep"], "tile")

    boxes = tiles.select("tile", "dim", "label", "vec").mapInArrow(box_batches, "tile int, dim int, first long, last long, low array<double>, high array<double>")
    sides = boxes.select("tile", "dim", "first", "last", F.posexplode(F.arrays_zip("low", "high"))).groupBy("tile", "dim", "pos")
    sides = sides.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min("col.low").alias("low"), F.max("col.high").alias("high"))
    sides = sides.groupBy("tile", "dim").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sort_array(F.collect_list(F.struct("pos", "low", "high"))).alias("sides"))
    boxes = stored(sides.select("tile", "dim", "first", "last", F.col("sides.low").alias("low"), F.col("sides.high").alias("high")), "negatives-boxes")
    pages = -(-boxes.count() // PAGE) or 1
    boxes = boxes.withColumn("page", F.pmod(F.hash("tile"), F.lit(pages)))

    anchors = rows.where("anchor").join(reps.select("rep", "label", "h", "vec"), ["label", "h", "vec"]).select("id", "key", "rep")
    anchors = stored(anchors, "negatives-anchors")
    asked = tiles.join(anchors.select("rep").distinct(), "rep", "left_semi").select("rep", "tile", "dim", "label", "vec")
    parts = max(1, -(-(asked.agg(F.sum("dim")).first()[0] or 0) // BLOCK))
    asked = _dealt(asked, parts, ["dim", "tile", "rep"], "block")
    blocks = (asked.agg(F.max("block")).first()[0] or 0) + 1

    def windows(lows, highs, marks):
        return asked_with.select("rep", "tile", "block", "dim", "label", "vec", *(x.alias(n) for x, n in zip((lows, highs, marks), ("lows", "highs", "marks"))))

    everything = F.array(F.lit(float("inf")))
    asked_with = asked
    opened = windows(F.array(F.lit(float("-inf"))), everything, F.array(F.lit(0.0)))
    seeded = tiles.groupBy("tile", "dim").cogroup(opened.groupBy("tile", "dim")).applyInArrow(lambda t, a: search_tile(t, a, positives + 1, True), FOUND)
    bound = seeded.groupBy("rep").agg(F.when(F.count("*") > positives, F.min("score")).alias("bound"))
    asked_with = asked.join(bound, "rep", "left")
    opened = windows(F.array(F.coalesce("bound", F.lit(float("-inf")))), everything, F.array(F.lit(0.0)))
    found = _search_all(tiles, boxes, pages, stored(opened, "negatives-positives"), blocks, positives + 1, True)
    found = stored(found.select("rep", "score", "id", "key"), "negatives-near")

    scores = found.select("rep", "score", F.ceil(F.col("score") * low / 100).cast("double").alias("low"), F.floor(F.col("score") * high / 100).cast("double").alias("high"))
    ranges = scores.where("low <= high").distinct().groupBy("rep").agg(F.collect_list(F.struct("low", "high", "score")).alias("w"))
    asked_with = asked.join(ranges, "rep")
    opened = windows(F.col("w.low"), F.col("w.high"), F.col("w.score"))
    apart = _search_all(tiles, boxes, pages, stored(opened, "negatives-windows"), blocks, negatives, False)
    apart = stored(apart.select("rep", "mark", F.col("nth").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), "negatives-found")

    met = found.select("rep", F.col("id").alias("positive_id"), F.col("key").alias("positive_key"), F.col("score").alias("positive_score"))
    met = anchors.withColumnRenamed("id", "anchor_id").join(met, "rep").where(F.col("key") != F.col("positive_key"))
    order = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id", "positive_key")
    met = met.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives).withColumn("mark", F.col("positive_score"))
    out = met.join(apart, ["rep", "mark"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", F.col("positive_score").cast("long").alias("positive_score"), F.col("negative_score").cast("long").alias("negative_score"))
