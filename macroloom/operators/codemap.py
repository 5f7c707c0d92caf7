"""Derive the mapping between two code vocabularies from the values reported under them.

Every code stands for the set of its (feature..., value) rows. Two codes match when most of the
left set is in the right set and no other right set comes close. Counting the overlap of every
pair of codes that share a row would pair all codes that report a common value such as zero, so
only pairs that can still decide a match are counted:

1. Codes with identical sets are copies; one of them stands for all.
2. A code of ``n`` rows, ``m`` of which occur on the right at all, matters only together with
   right sets that share at least ``t`` rows (``t`` = (score - margin) * n). Such a set shares
   one of any ``m - t + 1`` of the rows, so the rows that fewest right sets hold are probed
   and the widely held ones are not. The cut between the two comes from a histogram of how
   widely rows are held, so the rows of one code are never sorted in one task.
3. A right set smaller than ``t`` is out, and so is a pair whose shared probes plus all rows
   not probed stay below ``t``. For the pairs left, the rows not probed are counted too.

Nothing is cut off: every pair with an overlap of at least ``t`` is found with its exact count.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macroloom.functions.numbers import fingerprint_value
from macroloom.functions.text import unit_from_description
from macroloom.operators.observations import named
from macroloom.operators.positional import ordinal
from macroloom.operators.releases import keep_first_k
from macroloom.work import stored

MIN_SCORE = 0.90
MIN_MARGIN = 0.3
#: Rows that more right sets than this hold are compared by classes of sets, not by pairs.
RARE = 32


class CodeSets(NamedTuple):
    """One side of a comparison.

    ``rows``: the distinct (code, f0.., v) rows. ``heads``: the rows of one code per distinct
    set, with the size ``n`` of the set and the number of ``members`` that share it. ``codes``:
    (code, n, stands_for, members) of every code.
    """

    rows: DataFrame
    heads: DataFrame
    codes: DataFrame


def fingerprint(df: DataFrame, code: str, features, value: str) -> DataFrame:
    """Distinct (code, f0.., v) rows: the relational form of one value set per code."""
    shown = [named(f).alias(f"f{i}") for i, f in enumerate(features)]
    rows = df.select(named(code).alias("code"), *shown, fingerprint_value(named(value)).alias("v"))
    return rows.dropna().distinct()


def fingerprint_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("code").agg(F.count("*").alias("n"))


def _features(rows):
    """Columns of a row's identity. The value comes first: it tells rows apart soonest when sorting."""
    return ["v", *[c for c in rows.columns if c[:1] == "f"]]


def code_sets(df: DataFrame, code: str, features, value: str) -> CodeSets:
    """The value sets of one side, written once because every later step reads them."""
    rows = stored(fingerprint(df, code, features, value), "fingerprint")
    cols = _features(rows)
    # Rows are distinct per code, so xor identifies a set; two hashes make it 128 bits.
    marks = rows.groupBy("code").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64(*cols)).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(1), *cols)).alias("h2"),
    )
    groups = marks.groupBy("n", "h1", "h2").agg(F.min("code").alias("stands_for"), F.count("*").alias("members"))
    codes = stored(marks.join(groups, ["n", "h1", "h2"]).select("code", "n", "stands_for", "members"), "codes")
    leading = codes.filter(F.col("code") == F.col("stands_for")).select("code", "n", "members")
    return CodeSets(rows, rows.join(leading, "code"), codes)


def overlapping_sets(left_rows, right_rows, min_share: float) -> tuple[DataFrame, DataFrame]:
    """(left, right, n, members, overlap) for all pairs of sets with overlap >= min_share * n.

    ``left_rows`` and ``right_rows`` carry ``n`` and ``members`` and hold each set once. The
    second frame is (left) of all sets that share any row with the other side.
    """
    feats = _features(left_rows)
    held = right_rows.groupBy(*feats).agg(F.count("*").alias("held"))
    needed = F.greatest(F.ceil(F.col("n") * min_share - 1e-9), F.lit(1)).cast("bigint")
    probe_rows = stored(
        left_rows.join(held, feats)
        .withColumn("t", needed)
        .withColumn("bucket", F.floor(F.log2(F.col("held"))).cast("int"))
        .drop("held", "members"),
        "probes",
    )
    # Per left code: how many of its rows are held at all, and the bucket up to which they are probed.
    by_bucket = probe_rows.groupBy("code", "n", "t", "bucket").agg(F.count("*").alias("k"))
    up_to = Window.partitionBy("code").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        by_bucket.withColumns(
            {"cum": F.sum("k").over(up_to), "m": F.sum("k").over(Window.partitionBy("code"))}
        )
        .filter((F.col("m") >= F.col("t")) & (F.col("cum") >= F.col("m") - F.col("t") + 1))
        .groupBy("code", "m")
        .agg(F.min("bucket").alias("cut"), F.min("cum").alias("probed"))
    )
    placed = probe_rows.join(cuts, "code")
    left_side = [F.col("code").alias("left"), "n", "t", (F.col("m") - F.col("probed")).alias("rest"), *feats]
    right_side = right_rows.select(
        F.col("code").alias("right"), F.col("n").alias("right_n"), F.col("members").alias("members"), *feats
    )
    # Written because it is small, costly and read twice below.
    shared = stored(
        placed.filter(F.col("bucket") <= F.col("cut"))
        .select(*left_side)
        .join(right_side, feats)
        .filter(F.col("right_n") >= F.col("t"))
        .groupBy("left", "right", "n", "t", "rest", "members")
        .agg(F.count("*").alias("shared"))
        .filter(F.col("shared") + F.col("rest") >= F.col("t")),
        "pairs",
    )
    unprobed = placed.filter(F.col("bucket") > F.col("cut")).select(F.col("code").alias("left"), *feats)
    more = (
        shared.filter("rest > 0")
        .select("left", "right")
        .join(unprobed, "left")
        .join(right_side.select("right", *feats), ["right", *feats])
        .groupBy("left", "right")
        .agg(F.count("*").alias("more"))
    )
    pairs = (
        shared.join(more, ["left", "right"], "left")
        .withColumn("overlap", F.col("shared") + F.coalesce(F.col("more"), F.lit(0)))
        .filter(F.col("overlap") >= F.col("t"))
        .select("left", "right", "n", "members", "overlap")
    )
    return pairs, probe_rows.select(F.col("code").alias("left")).distinct()


def score_codes(left: CodeSets, right: CodeSets, min_score=MIN_SCORE, min_margin=MIN_MARGIN) -> DataFrame:
    """Every left code with its outcome.

    Columns: ``code_left``, ``n`` (rows of the code), ``code_right``, ``overlap``, ``ratio`` (the
    last three only where mapped) and ``outcome``: ``mapped``, ``ambiguous`` (shares rows with
    some right code but none stands out) or ``unmatched`` (shares none).
    """
    if min_margin < 0 or min_score <= 0:
        raise ValueError("min_score has to be positive and min_margin not negative")
    pairs, touching = overlapping_sets(left.heads, right.heads, min_score - min_margin)
    pairs = pairs.withColumn("ratio", F.col("overlap") / F.col("n"))
    order = [F.col("ratio").desc(), F.col("overlap").desc(), F.col("right").desc()]
    top = keep_first_k(pairs, ["left"], order, 2)
    best, second = F.col("rank") == 1, F.col("rank") == 2
    decided = top.groupBy("left").agg(
        F.max(F.when(best, F.col("right"))).alias("right"),
        F.max(F.when(best, F.col("overlap"))).alias("overlap"),
        F.max(F.when(best, F.col("ratio"))).alias("ratio"),
        # Another copy of the best set scores just as well as the best.
        F.max(
            F.when(second, F.col("ratio")).when(best & (F.col("members") > 1), F.col("ratio"))
        ).alias("runner_up"),
    )
    accepted = decided.filter(
        (F.col("ratio") >= min_score)
        & (F.col("ratio") - F.coalesce(F.col("runner_up"), F.lit(0.0)) > min_margin)
    ).select(F.col("left").alias("stands_for"), F.col("right").alias("code_right"), "overlap", "ratio")
    touched = touching.select(F.col("left").alias("stands_for"), F.lit(True).alias("touched"))
    scored = left.codes.join(accepted, "stands_for", "left").join(touched, "stands_for", "left")
    outcome = (
        F.when(F.col("code_right").isNotNull(), "mapped")
        .when(F.col("touched"), "ambiguous")
        .otherwise("unmatched")
    )
    return scored.select(F.col("code").alias("code_left"), "n", "code_right", "overlap", "ratio", outcome.alias("outcome"))


def top_overlaps(left_rows: DataFrame, right_rows: DataFrame, copies: DataFrame, k: int, rare: int = RARE) -> DataFrame:
    """(left, code_right, overlap): the ``k`` right codes that share most rows with each left set, ties to the greater code.

    ``left_rows`` and ``right_rows`` hold each set once (code, n, f0.., v); ``copies`` are the at
    most ``k`` greatest codes (right, code_right) of every right set.

    Rows that at most ``rare`` right sets hold are probed first. The k-th best count so far bounds
    the answer of a left set: where it exceeds the number of its widely held rows, a right set not met
    yet is out, and of those met only the ones that can still pass it have their widely held rows
    counted. The other left sets compare widely held rows by classes: left and right
    sets that hold the same of them are one class, two classes are compared once by bits
    (``_best_classes``), and of the right sets that share nothing rare with a left set only the k best
    of the classes matter.
    """
    feats = _features(left_rows)
    rights = right_rows.select(F.col("code").alias("right"), *feats)
    held = rights.groupBy(*feats).agg((F.count("*") > rare).alias("hot"))
    placed = stored(left_rows.select(F.col("code").alias("left"), *feats).join(held, feats), "placed")
    probed = placed.filter(~F.col("hot")).join(rights, feats).groupBy("left", "right").agg(F.count("*").alias("shared"))
    probed = stored(probed, "probed")
    kth = keep_first_k(probed, ["left"], [F.col("shared").desc()], k).groupBy("left")
    kth = kth.agg(F.when(F.count("*") == k, F.min("shared")).otherwise(0).alias("kth"))
    rest = placed.groupBy("left").agg(F.count(F.when(F.col("hot"), 1)).alias("rest"))
    state = rest.join(kth, "left", "left").withColumn("kth", F.coalesce("kth", F.lit(0)))
    state = stored(state.withColumn("open", (F.col("rest") > 0) & (F.col("kth") <= F.col("rest"))), "bounds")

    # Widely held rows of the pairs that share rare ones and can pass.
    hot_rows = stored(rights.join(held.filter("hot"), feats).select("right", *feats), "hot-rows")
    left_hot = placed.filter("hot").select("left", *feats)
    passing = probed.join(state, "left").filter(F.col("shared") + F.col("rest") >= F.col("kth"))
    passing = stored(passing.select("left", "right", "shared"), "passing")
    more = passing.select("left", "right").join(left_hot, "left").join(hot_rows, ["right", *feats])
    more = more.groupBy("left", "right").agg(F.count("*").alias("more"))
    both = passing.join(more, ["left", "right"], "left")
    both = both.select("left", "right", (F.col("shared") + F.coalesce("more", F.lit(0))).alias("overlap"))

    # Left sets that another right set may enter: classes of equal widely held rows, each pair of classes once.
    is_open = state.filter("open").select("left")
    left_part, left_class = _classes(left_hot.join(is_open, "left", "left_semi"), "left", feats)
    right_part, right_class = _classes(hot_rows, "right", feats)
    met = stored(_best_classes(left_part, right_part, feats, k), "classes")
    best_of_class = keep_first_k(right_class.join(copies, "right"), ["right_class"], [F.col("code_right").desc()], k)
    order = [F.col("more").desc(), F.col("code_right").desc()]
    unseen = keep_first_k(met.join(best_of_class.drop("rank"), "right_class"), ["left_class"], order, k)
    unseen = unseen.join(left_class, "left_class").select("left", "code_right", F.col("more").alias("overlap"))
    # A right set met both ways has its whole count in the first.
    found = both.join(copies, "right").select("left", "code_right", "overlap").union(unseen)
    found = found.groupBy("left", "code_right").agg(F.max("overlap").alias("overlap"))
    return keep_first_k(found, ["left"], [F.col("overlap").desc(), F.col("code_right").desc()], k)


def _best_classes(left_part: DataFrame, right_part: DataFrame, feats, k: int) -> DataFrame:
    """(left_class, right_class, more): every pair of classes that can be among the ``k`` best of the left one.

    Rows are packed 64 to a block, rows held about equally often together. Where two classes meet in a
    block, one AND of two numbers counts what they share there. A block whose rows are held apart by few
    classes each stays unpacked, if pairs by row are fewer. The right classes with most rows are compared
    first: the k-th best of them bounds what follows, so a pair is kept only where the block's count and all
    rows outside the block can reach the bound. Pairs below it are left out or counted short, both in vain.
    """
    spread = int(left_part.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lefts, rights = left_part.groupBy(*feats).agg(F.count("*").alias("l")), right_part.groupBy(*feats).agg(F.count("*").alias("r"))
    rows = lefts.join(rights, feats).withColumn("bucket", F.floor(F.log2("r")).cast("int")).withColumn("h", F.xxhash64(*feats))
    rows = ordinal(rows, ["bucket"], ["h", *feats], "nr", chunk=F.shiftright("h", 52))
    rows = stored(rows.select(*feats, "l", "r", "bucket", (F.col("nr") / 64).cast("long").alias("block"), (F.col("nr") % 64).cast("int").alias("pos")), "hot-rows")
    at = ["bucket", "block"]

    def classes_of(part, name):
        return part.join(rows, feats).groupBy(*at).agg(F.countDistinct(name).cast("double").alias(name))

    by_row = rows.groupBy(*at).agg(F.sum(F.col("l").cast("double") * F.col("r")).alias("pairs"))
    costs = by_row.join(classes_of(left_part, "left_class"), at).join(classes_of(right_part, "right_class"), at)
    packed = costs.select(*at, (F.col("left_class") * F.col("right_class") <= F.col("pairs")).alias("packed"))
    placed = stored(rows.join(packed, at).select(*feats, *at, F.when(F.col("packed"), -1).otherwise(F.col("pos")).alias("row"), "pos"), "hot-rows")
    key = [*at, "row"]

    def bits(part, name, side):
        packs = part.join(placed, feats).groupBy(name, *key).agg(F.bit_or(F.expr("shiftleft(1L, pos)")).alias(side))
        sizes = packs.groupBy(name).agg(F.sum(F.bit_count(side)).alias(f"{side}_size"))
        return stored(packs.join(sizes, name).withColumn(f"{side}_other", F.col(f"{side}_size") - F.bit_count(side)), "bits")

    a, b = bits(left_part, "left_class", "a"), bits(right_part, "right_class", "b")
    count = F.bit_count(F.col("a").bitwiseAND(F.col("b")))
    largest = b.select("right_class", "b_size").distinct().orderBy(F.col("b_size").desc(), "right_class").limit(16 * k).select("right_class")
    first = a.join(b.join(largest, "right_class", "left_semi"), key).groupBy("left_class", "right_class").agg(F.sum(count).alias("more"))
    kth = keep_first_k(first, ["left_class"], [F.col("more").desc()], k).groupBy("left_class")
    kth = kth.agg(F.when(F.count("*") == k, F.min("more")).otherwise(1).alias("bound"))
    bounded = a.join(kth, "left_class", "left").withColumn("bound", F.greatest(F.coalesce("bound", F.lit(1)), F.lit(1)))
    # A packed block may hold all classes, so its right ones are dealt over all tasks and its left ones go to each.
    dealt = F.when(F.col("row") == -1, F.lit(spread)).otherwise(F.lit(1))
    bounded = bounded.withColumn("part", F.explode(F.sequence(F.lit(0), dealt - 1)))
    b = b.withColumn("part", F.pmod(F.xxhash64("right_class"), dealt).cast("int"))
    by = [*key, "part"]
    met = bounded.repartition(spread, *by).join(b.repartition(spread, *by), by)
    met = met.where((count > 0) & (count + F.least("a_other", "b_other") >= F.col("bound")))
    met = met.groupBy("left_class", "right_class").agg(F.sum(count).alias("more"), F.max("bound").alias("bound"))
    return met.where("more >= bound").select("left_class", "right_class", "more")


def _classes(rows: DataFrame, code: str, feats) -> tuple[DataFrame, DataFrame]:
    """Rows of one code per distinct row set (<code>_class, f0.., v), and (code, <code>_class) of all codes."""
    name = f"{code}_class"
    marks = rows.groupBy(code).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(*feats)).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), *feats)).alias("h2")
    )
    groups = marks.groupBy("n", "h1", "h2").agg(F.min(code).alias(name))
    members = stored(marks.join(groups, ["n", "h1", "h2"]).select(code, name), "classes")
    leading = members.filter(F.col(code) == F.col(name))
    return rows.join(leading, code).select(name, *feats), members


def candidates_for(codes: DataFrame, left: CodeSets, right: CodeSets, k=3, min_share=0.0) -> DataFrame:
    """The ``k`` best right codes of each left code in ``codes`` (column ``code_left``).

    A report for people who resolve ambiguous codes. Every shared value counts, and a left code with
    fewer than ``k`` partners that share at least ``min_share`` of its rows has fewer rows.
    """
    wanted = left.codes.join(codes.select(F.col("code_left").alias("code")).distinct(), "code", "left_semi")
    wanted_sets = wanted.select(F.col("stands_for").alias("code")).distinct()
    # Copies tie, and ties go to the greater code, so k copies of a set are all that can be listed.
    copies = keep_first_k(
        right.codes.select(F.col("code").alias("code_right"), F.col("stands_for").alias("right")),
        ["right"], [F.col("code_right").desc()], k,
    ).drop("rank")
    top = top_overlaps(left.heads.join(wanted_sets, "code", "left_semi"), right.heads, stored(copies, "copies"), k)
    members = wanted.select(F.col("code").alias("code_left"), F.col("stands_for").alias("left"), "n")
    listed = top.join(members, "left").filter(F.col("overlap") >= F.col("n") * min_share - 1e-9)
    return listed.select("code_left", "rank", "code_right", "overlap", (F.col("overlap") / F.col("n")).alias("ratio"))


def attribute_targets(left, right, keys, value, group, attr_left, attr_right) -> DataFrame:
    """Right-hand attributes met by each (group.., left attribute) on rows equal in key and value.

    ``n_targets`` above one means ambiguous. Both sides are distinct before they are joined, so
    a key that many rows repeat pairs each attribute value once.
    """
    v = fingerprint_value(named(value)).alias("__v")
    a = left.select(*[named(k) for k in keys], v, named(attr_left).alias("__a")).dropna().distinct()
    b = right.select(*[named(k) for k in keys], v, named(attr_right).alias("__b")).dropna().distinct()
    met = a.join(b, [*keys, "__v"]).select(*[named(g) for g in group], "__a", "__b").distinct()
    return met.groupBy(*[named(g) for g in group], F.col("__a").alias(attr_left)).agg(
        F.count("*").alias("n_targets"), F.min("__b").alias("target")
    )


def resolve_attributes(pairs, matched, overrides, on, label="label", out="unit") -> DataFrame:
    """Target of every observed pair and where it came from.

    In order: the value match, the wording of the label, the override table. An override with a
    null target is a decision, not a gap. What none of them explains is ``unexplained``.
    """
    a = matched.select(*[named(c) for c in on], named(out).alias("__matched"))
    o = overrides.select(*[named(c) for c in on], named(out).alias("__override"), F.lit(True).alias("__decided"))
    joined = pairs.join(a, list(on), "left").join(o, list(on), "left")
    worded = unit_from_description(named(label))
    source = (
        F.when(F.col("__matched").isNotNull(), "matched")
        .when(worded.isNotNull(), "label")
        .when(F.col("__override").isNotNull(), "override")
        .when(F.col("__decided"), "no unit")
        .otherwise("unexplained")
    )
    return joined.select(
        *[named(c) for c in on],
        named(label),
        F.coalesce(F.col("__matched"), worded, F.col("__override")).alias(out),
        source.alias("source"),
    )


def missing_codes(codes: DataFrame, *known: DataFrame) -> DataFrame:
    """Codes of ``codes`` (first column) that are in none of the ``known`` frames (first columns)."""
    return reduce(
        lambda rest, k: rest.join(k.select(named(k.columns[0]).alias(rest.columns[0])), rest.columns[0], "left_anti"),
        known,
        codes.distinct(),
    )
