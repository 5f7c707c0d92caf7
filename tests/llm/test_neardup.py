import random
from collections import Counter

import numpy as np

from macroloom.llm import neardup
from macroloom.llm.common import may_be_in
from macroloom.llm.components import components
from macroloom.llm.decontaminate import words_of


def shingles(text):
    words = words_of((text or "").encode())
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    both = a.keys() | b.keys()
    return sum(min(a[x], b[x]) for x in both) / sum(max(a[x], b[x]) for x in both) if both else 0.0


def root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(rows):
    parent = {i: i for i, _ in rows}
    kept = [(i, shingles(t)) for i, t in rows]
    for n, (i, a) in enumerate(kept):
        for j, b in kept[:n]:
            if a and b and similarity(a, b) >= 0.8:
                x, y = root(parent, i), root(parent, j)
                parent[max(x, y)] = min(x, y)
    return {i: root(parent, i) for i in parent}


def corpus():
    rng = random.Random(6)
    prose = lambda n: [rng.choice("the of and tion ble ing er on an re".split()) + rng.choice("abcdefgh") for _ in range(n)]
    texts = [" ".join(prose(rng.randint(1, 120))) for _ in range(40)]
    base = prose(150)
    for _ in range(40):  # a large group at distances around the threshold
        own = list(base)
        for _ in range(rng.randint(1, 5)):
            own[rng.randrange(len(own))] = rng.choice(["x", "y", "z"])
        texts.append(" ".join(own))
    walk = prose(200)
    for _ in range(12):  # a chain
        walk = list(walk)
        walk[rng.randrange(len(walk))] = "w"
        walk[rng.randrange(len(walk))] = "v"
        texts.append(" ".join(walk))
    texts += [texts[0].upper(), texts[0] + "!", "one two", "One. Two", "", None, "?", "", "a b c d e " * 400, "a b c d e " * 390, "a b c d e " * 200, texts[50], texts[50]]
    return texts


def test_classes_agree_with_all_pairs(spark):
    texts = corpus()
    ids = list(range(100, 100 + len(texts)))
    random.Random(1).shuffle(ids)
    rows = list(zip(ids, texts))
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in rows] + [(None, texts[0], 0, "k"), (*rows[0], 0, "k")], "doc_id long, text string, component int, keys string")
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows) + 2
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == brute(rows)
    assert all(r.kept == (r.component_id in (None, r.doc_id)) for r in got)
    assert neardup.near_duplicates(docs.where("false")).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(2)
    a = [rng.choice("abcdefgh").encode() for _ in range(300)]
    b = a[:240] + [rng.choice("ijkl").encode() for _ in range(60)]
    owner, region = neardup.unit_regions([a, b, [b"one"]], neardup.WordHashes())
    signs = neardup.signatures(owner, region, 3, 2000)
    want = similarity(shingles(" ".join(x.decode() for x in a)), shingles(" ".join(x.decode() for x in b)))
    assert abs((signs[0] == signs[1]).mean() - want) < 0.04
    assert (signs != 0).all() and np.array_equal(signs[2], neardup.signatures(owner[owner == 2] - 2, region[owner == 2], 1, 2000)[0])


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 199), (199, 200)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 61)}, **{100 + i: 100 for i in range(50)}, 199: 199, 200: 199}


def test_only_rows_that_an_exact_join_may_want_are_shuffled(spark):
    rows = spark.range(20_000).selectExpr("id", "cast(id as string) as name", "id as _place")
    wanted = spark.range(0, 20_000, 40).selectExpr("cast(id as string) as x")
    got = {r.id for r in may_be_in(rows, "name", wanted.union(spark.sql("SELECT CAST(NULL AS STRING)"))).collect()}
    assert got >= set(range(0, 20_000, 40)) and len(got) < 600
    assert may_be_in(rows, "id", spark.range(0)).columns == ["id", "name", "_place"]
    assert may_be_in(rows, "id", spark.range(0)).count() == 0


def test_a_group_of_texts_with_words_of_their_own_is_not_compared_pairwise(spark, monkeypatch):
    """Texts that share too little with all others together link with none; they reach no block."""
    kinds = "rep long, component long, weight long"
    lists = [(i, [7, 8, 9, *range(1000 * i, 1000 * i + (7 if i < 200 else 0))]) for i in range(1, 203)]
    regions = spark.createDataFrame([(i, [], r) for i, r in lists], "id long, others array<long>, regions array<long>")
    members = spark.createDataFrame([(i, i, len(r)) for i, r in lists], kinds)
    assert {r.rep for r in neardup._can_link(members, regions, 0.8).collect()} == {200, 201, 202}

    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(w if k not in (10, 30, 50) else f"own{i}x{k}" for k, w in enumerate(base)) for i in range(60)]
    texts += [" ".join([*base, "more"]), " ".join(base)]
    asked = []
    real = neardup._can_link
    monkeypatch.setattr(neardup, "_can_link", lambda *a: asked.append(real(*a)) or asked[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == brute(list(enumerate(texts)))
    assert asked and asked[0].count() <= 2
