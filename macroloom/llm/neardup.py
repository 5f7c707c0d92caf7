"""Near-duplicate documents by weighted word shingles and DartMinHash signatures."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.llm.common import may_be_in, portions, stored
from macroloom.llm.components import components
from macroloom.llm.decontaminate import words_of

#: Words of a shingle, and the least weighted Jaccard similarity of a link.
SHINGLE, THRESHOLD = 5, 0.8
#: A pair of the least similarity has no common band once in (1 - 0.8**5)**-28 = 66,000 times.
BANDS, ROWS = 28, 5
#: Turns of further leaders at most, before what they leave open is compared in blocks.
TURNS = 3
#: Regions and documents of a block (in expectation).
REGIONS, SIDE = 1 << 17, 512
#: Distinct words whose hashes a task keeps.
STORE_WORDS = 500_000

_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mix(h: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number."""
    h = h + _K[0]
    h = (h ^ (h >> np.uint64(30))) * _K[1]
    h = (h ^ (h >> np.uint64(27))) * _K[2]
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def unit_regions(word_lists: Sequence[list[bytes]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(document, region) of all shingles: a shingle that occurs n times has n regions of unit weight.

    A document of one to four words has one shingle of all of them, one without words none.
    """
    if len(hashes) > STORE_WORDS:
        hashes.clear()
    sizes = np.array([len(w) for w in word_lists], np.int64)
    owners, values = [], []
    short = [i for i in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)).tolist()]
    for i in short:
        owners.append(np.array([i]))
        values.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(word_lists[i]))], np.uint64))
    long = np.flatnonzero(sizes >= SHINGLE)
    if len(long):
        words = np.fromiter((hashes[w] for i in long.tolist() for w in word_lists[i]), np.uint64, int(sizes[long].sum()))
        owner = np.repeat(long, sizes[long])
        left = np.concatenate([np.arange(n, 0, -1) for n in sizes[long].tolist()])
        h = np.zeros(len(words) - SHINGLE + 1, np.uint64)
        for k in range(SHINGLE):
            h = mix(h ^ words[k : len(words) - SHINGLE + 1 + k])
        inside = left[: len(h)] >= SHINGLE
        owners.append(owner[: len(h)][inside])
        values.append(h[inside])
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])))
    begin = np.flatnonzero(new)
    level = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
    return owner, mix(value + level.astype(np.uint64) * _K[1])


def signatures(owner: np.ndarray, region: np.ndarray, documents: int, coordinates: int) -> np.ndarray:
    """DartMinHash signatures of documents (none of them without regions).

    Darts hit each unit region at exponential intervals, drawn from the region's name, so documents
    that share a region share its darts. A dart belongs to one coordinate, and each coordinate keeps
    the earliest dart of the document. Two documents agree in a coordinate with the probability of
    their weighted Jaccard similarity. Only darts up to a time are thrown by which about
    k(ln k + 2) of them have hit; documents with a coordinate still empty get twice the time.
    """
    weight = np.bincount(owner, minlength=documents)
    until = coordinates * (math.log(coordinates) + 2) / np.maximum(weight, 1)
    out = np.zeros((documents, coordinates), np.uint64)
    todo = np.ones(len(owner), bool)
    while todo.any():
        who, name = owner[todo], region[todo]
        time, throw, hits = np.zeros(len(who)), 0, []
        while len(who):
            dart = mix(name + np.uint64(throw * int(_K[2]) % (1 << 64)))
            time = time - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0)
            early = time <= until[who]
            who, name, time, dart = who[early], name[early], time[early], dart[early]
            hits.append((who, time, mix(dart)))
            throw += 1
        who, time, dart = (np.concatenate(x) for x in zip(*hits))
        place = who * coordinates + (dart % np.uint64(coordinates)).astype(np.int64)
        late = np.argsort(-time, kind="stable")
        filled = np.zeros(documents * coordinates, bool)
        filled[place] = True
        flat = np.zeros(documents * coordinates, np.uint64)
        flat[place[late]] = dart[late]  # the earliest is written last
        full = filled.reshape(documents, coordinates).all(1)
        out[full] = np.where(out[full].any(1)[:, None], out[full], flat.reshape(documents, coordinates)[full])
        again = ~full & (weight > 0) & ~out.any(1)
        until = np.where(again, 2 * until, until)
        todo = again[owner]
    return out


def band_keys(signs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of coordinates."""
    h = np.zeros((len(signs), BANDS), np.uint64)
    for r in range(ROWS):
        h = mix(h ^ signs[:, r::ROWS][:, :BANDS])
    return h


def sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, digest of the words, weight, band keys); without words digest and keys are null."""
    hashes = WordHashes()
    for batch in portions(batches, 1, 1 << 20):
        words = [words_of(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
        digests = [hashlib.sha256(b" ".join(w)).digest() if w else None for w in words]
        first: dict[bytes, int] = {}
        for i, d in enumerate(digests):
            if d is not None:
                first.setdefault(d, i)
        distinct = list(first.values())
        owner, region = unit_regions([words[i] for i in distinct], hashes)
        keys = band_keys(signatures(owner, region, len(distinct), BANDS * ROWS)).view(np.int64) if distinct else np.zeros((0, BANDS), np.int64)
        weight = np.bincount(owner, minlength=len(distinct))
        at = {i: n for n, i in enumerate(distinct)}
        which = [at[first[d]] if d is not None else None for d in digests]
        columns = [
            batch.column(0),
            pa.array(digests, pa.binary()),
            pa.array([0 if n is None else int(weight[n]) for n in which], pa.int64()),
            pa.array([None if n is None else keys[n].tolist() for n in which], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "weight", "keys"])


def region_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, others) to (id, others, regions)."""
    hashes = WordHashes()
    for batch in portions(batches, 1):
        words = [words_of(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
        owner, region = unit_regions(words, hashes)
        offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(words)))))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(region.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], names=["id", "others", "regions"])


def shared_regions(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Number of regions that each document of one side shares with each of the other, some thousand regions at a time."""
    sizes = np.array([len(x) for x in one + other])
    _, codes, often = np.unique(np.concatenate(one + other), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    held = often[codes] > 1  # a region that one document alone has is shared by none
    codes, owner = (np.cumsum(often > 1) - 1)[codes[held]], owner[held]
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    out = np.zeros((len(one), len(other)), np.float32)
    for start in range(0, int(codes[-1]) + 1 if len(codes) else 0, 8192):
        a, b = np.searchsorted(codes, (start, start + 8192))
        held = np.zeros((len(sizes), 8192), np.float32)
        held[owner[a:b], codes[a:b] - start] = 1
        out += held[: len(one)] @ held[len(one) :].T
    return out


def cell_links(cell: pa.Table, threshold: float) -> pa.Table:
    """(block, rep, component, weight, regions) of one or two blocks to links (a, b), one for each two components.

    Every document of a block is compared with every one of the other block, or of its own if there
    is but one, unless the two are of one component or their weights rule a link out.
    """
    kind = cell.schema.field("rep").type
    cell = cell.sort_by("rep").combine_chunks()
    first = pc.equal(cell.column("block"), cell.column("i"))
    same = cell.column("i")[0] == cell.column("j")[0]
    sides = [cell, cell] if same else [cell.filter(first), cell.filter(pc.invert(first))]
    none = pa.table({"a": pa.array([], kind), "b": pa.array([], kind)})
    if not all(map(len, sides)):
        return none
    component = [x.column("component").combine_chunks().dictionary_encode() for x in sides]
    names, which = np.unique(np.concatenate([np.array(c.dictionary.to_pylist())[c.indices.to_numpy()] for c in component]), return_inverse=True)
    of = [which[: len(sides[0])], which[len(sides[0]) :]]
    weight = [x.column("weight").to_numpy() for x in sides]
    asked = of[0][:, None] != of[1][None, :]
    asked &= np.minimum(weight[0][:, None], weight[1][None, :]) >= (threshold - 1e-9) * np.maximum(weight[0][:, None], weight[1][None, :])
    if same:
        asked = np.triu(asked, 1)
    rows, columns = np.flatnonzero(asked.any(1)), np.flatnonzero(asked.any(0))
    if not len(rows):
        return none
    lists = [[x.column("regions")[int(i)].values.to_numpy() for i in some] for x, some in zip(sides, (rows, columns))]
    shared = shared_regions(*lists)
    total = weight[0][rows][:, None] + weight[1][columns][None, :] - shared
    i, j = np.nonzero(asked[np.ix_(rows, columns)] & (shared >= threshold * total))
    a, b = rows[i], columns[j]
    _, one = np.unique(np.stack([of[0][a], of[1][b]]), axis=1, return_index=True) if len(a) else (None, np.zeros(0, np.int64))
    return pa.table({"a": sides[0].column("rep").take(pa.array(a[one])), "b": sides[1].column("rep").take(pa.array(b[one]))})


def similarities(pairs: DataFrame, regions: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs: exact weighted Jaccard similarity, as shared over all unit regions."""
    pairs = stored(pairs, "neardup-pairs")
    one = may_be_in(regions, "id", pairs.select("a")).select(F.col("id").alias("a"), F.col("regions").alias("of_a"))
    return _similarities(pairs.join(one, "a"), regions, pairs.select("b"))


def _similarities(of_one: DataFrame, regions: DataFrame, others: DataFrame) -> DataFrame:
    """``similarities`` of pairs that have the regions of a already: (a, b, of_a); ``others`` has all b."""
    two = may_be_in(regions, "id", others).select(F.col("id").alias("b"), F.col("regions").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return of_one.join(two, "b").select("a", "b", (shared / (F.size("of_a") + F.size("of_b") - shared)).alias("similarity"))


def _united(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (rep, component) after the links (a, b) between members have made some of them one."""
    one, other = classes.toDF("a", "of_a"), classes.toDF("b", "of_b")
    between = links.join(one, "a").join(other, "b").where("of_a != of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    new = components(between).toDF("component", "joined")
    return stored(classes.join(new, "component", "left").select("rep", F.coalesce("joined", "component").alias("component")), "neardup-classes")


def _drawn_closer(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes after each linked one has joined the least class it is linked with, and what that one joined.

    One step, not all: the turn after it goes on from there, and ``components`` finishes.
    """
    one, other = classes.toDF("a", "of_a"), classes.toDF("b", "of_b")
    between = links.join(one, "a").join(other, "b").where("of_a != of_b")
    step = between.groupBy(F.greatest("of_a", "of_b").alias("component")).agg(F.min(F.least("of_a", "of_b")).alias("joined"))
    step = stored(step, "neardup-step")
    two = step.join(step.toDF("joined", "further"), "joined", "left").select("component", F.coalesce("further", "joined").alias("joined"))
    return stored(classes.join(two, "component", "left").select("rep", F.coalesce("joined", "component").alias("component")), "neardup-classes")


def _placed(placed: DataFrame, classes: DataFrame) -> DataFrame:
    """(bucket, rep, component): classes are joined on one row a document, whose buckets follow."""
    return placed.join(classes, "rep").select("rep", "component", F.explode("buckets").alias("bucket"))


def _with_other_leaders(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each bucket's leader of this turn, chosen by a hash, with the members of other components."""
    order = F.xxhash64("rep", "bucket", F.lit(turn))
    leaders = members.groupBy("bucket").agg(F.min(F.struct(order.alias("h"), "rep", "component")).alias("x")).select("bucket", F.col("x.rep").alias("leader"), F.col("x.component").alias("home"))
    pairs = members.join(leaders, "bucket").where("component != home")
    return pairs.select(F.greatest("rep", "leader").alias("a"), F.least("rep", "leader").alias("b")).distinct()


def _can_link(members: DataFrame, regions: DataFrame, threshold: float) -> DataFrame:
    """Of members (rep, weight, component), those that may link with one of another component.

    A link shares at least ``threshold`` of either document's regions, so a document of which fewer
    are held in any other component has none. Regions are counted once, whatever their groups' sizes.
    """
    held = members.select(F.col("rep").alias("id"), "component").distinct()
    units = may_be_in(regions, "id", held.select("id")).join(held, "id").select("id", "component", F.explode("regions").alias("region"))
    common = units.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("region")
    shared = units.join(common, "region").groupBy(F.col("id").alias("rep")).agg(F.count("*").alias("shared"))
    least = members.groupBy("rep").agg(F.min("weight").alias("least"))
    return shared.join(least, "rep").where(F.col("shared") >= F.col("least") * (threshold - 1e-9)).select("rep")


def _compared_in_blocks(placed: DataFrame, classes: DataFrame, regions: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the components that buckets still hold.

    Each document of such a bucket is in one block of the largest one it is in. Two blocks that meet in a
    bucket are a cell, once, however many buckets they meet in, and hold there the documents that
    these buckets have. A document's regions travel once for each of its cells.
    """
    members = _placed(placed, classes)
    mixed = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    mixed = stored(mixed.where("low != high and n > 2").select("bucket", "n"), "neardup-mixed")
    held = members.join(mixed, "bucket")
    able = _can_link(held.select("rep", "component").distinct().join(placed.select("rep", "weight"), "rep"), regions, threshold)
    held = held.join(stored(able, "neardup-able"), "rep", "left_semi")
    homes = held.groupBy("rep").agg(F.max(F.struct("n", "bucket")).alias("home"), F.collect_list("bucket").alias("buckets"))
    homes = homes.join(placed.select("rep", "weight"), "rep").select("rep", "weight", F.col("home.bucket").alias("home"), "buckets")
    homes = stored(homes, "neardup-homes")
    sizes = homes.groupBy("home").agg(F.ceil(F.greatest(F.sum("weight") / REGIONS, F.count("*") / SIDE)).alias("blocks"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("rep", F.lit(7)), "blocks"))
    homes = stored(homes.join(sizes, "home").select("rep", "weight", "buckets", block.alias("block")), "neardup-blocks")
    inside = homes.select("rep", "block", F.explode("buckets").alias("bucket"))
    met = inside.groupBy("bucket").agg(F.collect_set("block").alias("others"))
    # The blocks that a document meets in any bucket, each once.
    cells = inside.join(met, "bucket").groupBy("rep", "block").agg(F.array_distinct(F.flatten(F.collect_set("others"))).alias("others"))
    cells = cells.select("rep", "block", F.explode("others").alias("other"))
    cells = cells.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep").distinct()
    whole = homes.select("rep", "block", "weight").join(classes, "rep")
    whole = whole.join(may_be_in(regions, "id", whole.select("rep")).select(F.col("id").alias("rep"), "regions"), "rep")
    kind = dict(placed.dtypes)["rep"]
    return cells.join(whole, "rep").groupBy("i", "j").applyInArrow(lambda cell: cell_links(cell, threshold), f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, weight, component_id, kept) of every document.

    Documents link when the weighted Jaccard similarity of their shingles of five words, weighted by
    how often they occur, is at least ``threshold``. A class is what links lead to; ``component_id``
    is its least id and only that document is kept. ``weight`` is the number of shingles.

    Texts of equal words are one class from the start and only the least id goes on. Others meet in
    bands of their signatures. In a bucket all members are compared with its least one, not with
    each other. While that leaves many pairs of a bucket in different components, members of other
    components than a further one, chosen by a hash, are compared with that one, which joins most
    large groups. What is then left of a bucket in different components is compared in blocks, unless
    known distances to the least member rule a link out by the triangle inequality; so every pair
    that meets is linked, of one component, or known not to be similar. All comparisons are exact.

    Documents without words (null, empty) link with nothing. Repeated rows have equal words and are
    one class; different texts under one id are one document with both texts' links. A row with a
    null id is a class of its own with a null ``component_id``, and kept. Other columns are ignored.
    """
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    signed = stored(rows.mapInArrow(sign_batches, f"id {kind}, digest binary, weight long, keys array<long>"), "neardup-signed")
    unique = (
        signed.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
        .groupBy("digest")
        .agg(F.min("id").alias("rep"), F.first("keys").alias("keys"), F.first("weight").alias("weight"))
    )
    unique = stored(unique, "neardup-unique")
    bands = unique.select("rep", F.posexplode("keys").alias("band", "key")).select("rep", F.xxhash64("band", "key").alias("bucket"))
    # Most buckets hold one document: counts alone are shuffled to find the others.
    often = stored(bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "neardup-often")
    bands = may_be_in(bands, "bucket", often)
    sets = bands.groupBy("bucket").agg(
        F.min("rep").alias("leader"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("rep")).alias("h1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("h2")
    )
    # Buckets of the same members, as two near copies have in most bands, are opened once.
    sets = sets.where("n > 1").groupBy("n", "h1", "h2", "leader").agg(F.min("bucket").alias("bucket")).select("bucket", "leader")
    members = stored(bands.join(sets, "bucket"), "neardup-members")
    placed = members.groupBy("rep").agg(F.collect_list("bucket").alias("buckets")).join(unique.select("rep", "weight"), "rep")
    placed = stored(placed, "neardup-placed")

    wanted = members.groupBy(F.col("rep").alias("id")).agg(F.collect_set(F.when(F.col("rep") != F.col("leader"), F.col("leader"))).alias("others"))
    wanted = stored(wanted, "neardup-wanted")
    texts = may_be_in(rows, "id", wanted.select("id")).join(wanted, "id")
    regions = stored(texts.select("id", "text", "others").mapInArrow(region_batches, f"id {kind}, others array<{kind}>, regions array<long>"), "neardup-regions")
    stars = regions.select(F.col("id").alias("a"), F.explode("others").alias("b"), F.col("regions").alias("of_a"))
    judged = stored(_similarities(stars, regions, members.where("rep != leader").select("leader")), "neardup-stars")
    apart = placed.select("rep", F.col("rep").alias("component"))
    links = judged.where(F.col("similarity") >= threshold).select("a", "b")
    classes = _united(apart, links)

    asked = judged.select("a", "b")
    for turn in range(TURNS):
        members = _placed(placed, classes)
        open_pairs = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        open_pairs = open_pairs.groupBy("bucket").agg(F.sum("n").alias("n"), (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("ordered"))
        left, all_members = open_pairs.agg(F.sum("ordered"), F.sum("n")).first()
        if (left or 0) <= 2 * (all_members or 0):  # no more pairs than members: as many comparisons as a turn
            break
        pairs = _with_other_leaders(members, turn).join(asked, ["a", "b"], "left_anti")
        found = stored(similarities(pairs, regions), f"neardup-turn{turn}")
        new = found.where(F.col("similarity") >= threshold).select("a", "b")
        if new.isEmpty():
            break
        asked, links = asked.union(found.select("a", "b")), links.union(new)
        classes = _drawn_closer(classes, new)

    found = stored(_compared_in_blocks(placed, classes, regions, threshold), "neardup-more")
    classes = _united(classes, links.union(found))
    final = classes.select("rep", F.col("component").alias("component_id"))

    named = unique.select("digest", "rep").join(final, "rep", "left").select("digest", F.coalesce("component_id", "rep").alias("component_id"))
    own = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id"))
    return signed.join(named, "digest", "left").select(
        F.col("id").alias(id_column), "weight", own.alias("component_id"), F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept")
    )
