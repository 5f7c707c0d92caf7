import numpy as np

from macroloom.llm import negatives
from conftest import rows

SCHEMA = "vec_id long, embedding array<double>, label int, rep string"


def brute(table, marked, positives=5, fewest=3):
    """Literal reading of the rules over a list of rows."""
    good = [r for r in table if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = [np.floor(256.0 * np.array(r[1])) for r in good]
    out = []
    for i, a in enumerate(good):
        if not marked(a[0]):
            continue
        scored = [(-int(whole[i] @ whole[j]), b[0], j, b[2]) for j, b in enumerate(good) if j != i and len(b[1]) == len(a[1])]
        for p in sorted(x for x in scored if x[3] == a[2])[:positives]:
            fits = sorted(x for x in scored if x[3] != a[2] and 50 * -p[0] <= 100 * -x[0] <= 95 * -p[0])[:fewest]
            out += [(a[0], p[1], n, x[1], -p[0], -x[0]) for n, x in enumerate(fits, 1)]
    return sorted(out, key=str)


def make(rng, n, dim, labels=4):
    """Vectors around a few centres, with copies, near copies, and small whole numbers for ties."""
    centres = rng.standard_normal((6, dim))
    data = np.concatenate([centres[rng.integers(0, 6, n)] + 0.3 * rng.standard_normal((n, dim)), rng.integers(-1, 2, (n // 2, dim)).astype(float)])
    data = np.concatenate([data, data[: n // 5], np.repeat(data[:1], n // 3, 0)])
    return [(int(i), v.tolist(), int(rng.integers(0, labels)), "x") for i, v in zip(rng.permutation(len(data)), data)]


def agree(spark, table, step=7):
    out = negatives.mine_negatives(spark.createDataFrame(table, SCHEMA), f"vec_id % {step} = 0")
    assert rows(out) == brute(table, lambda i: i % step == 0)


def test_one_tile(spark):
    agree(spark, make(np.random.default_rng(1), 120, 5))


def test_many_tiles_blocks_and_pages(spark, monkeypatch):
    for name, value in {"TILE": 150, "BLOCK": 60, "PAGE": 3, "LEAF": 4, "FANOUT": 2, "WAITING": 50}.items():
        monkeypatch.setattr(negatives, name, value)
    agree(spark, make(np.random.default_rng(2), 90, 4), step=11)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    table = make(np.random.default_rng(3), 40, 3)
    table += [(1000 + i, v, 1, "y") for i, v in enumerate([None, [], [0.0] * 3, [nan, 1.0, 1.0], [1.0, None, 1.0], [inf, 1.0, 1.0]])]
    table += [(2000, [1.0, 1.0, 1.0], None, "y"), (None, [1.0, 1.0, 1.0], 1, "y"), (2002, [1.0, 2.0], 1, "y"), (2009, [2.0, 1.0], 1, "y"), (2010, [1.5, 1.0], 2, "y")]
    table += [table[0], table[0], (table[0][0], table[1][1], 3, "z")]  # repeated rows, and another row of one id
    agree(spark, table)
    assert negatives.mine_negatives(spark.createDataFrame([], SCHEMA), "true").count() == 0
    assert negatives.mine_negatives(spark.createDataFrame(table, SCHEMA), "false").count() == 0


def test_boxes_are_pruned():
    """Far groups are never opened, and what is found is the same as by looking at everything."""
    rng = np.random.default_rng(4)
    centres = 40.0 * rng.standard_normal((64, 8))
    data = np.floor(np.repeat(centres, 64, 0) + rng.standard_normal((4096, 8)))
    labels = np.zeros(4096, np.int64)
    tree = negatives.Tree(data, labels)
    first = [np.arange(4097), np.arange(4096), np.arange(4096)]
    asked = data[:64:16]
    best = negatives.Best(np.full((4, 1), -np.inf), np.full((4, 1), np.inf), 5)
    opened = []
    add = best.add
    best.add = lambda who, scores, allowed, at: (opened.append(len(at)), add(who, scores, allowed, at))[1]
    negatives.search(tree, first, asked, labels[:4], best, same=True)
    who, _, score, ids, _, _ = best.entries(first)
    full = asked @ data.T
    want = [sorted(range(4096), key=lambda j: (-full[a, j], j))[:5] for a in range(4)]
    assert ids.reshape(4, 5).tolist() == want and sum(opened) < 4096 / 4
