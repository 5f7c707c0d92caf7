import numpy as np

from macroloom.llm import embeddup


def brute(rows, threshold=0.98):
    def sound(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    good = [r for r in rows if sound(r)]
    links, parent = {}, {r[0]: r[0] for r in good}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    units = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) for r in good]
    for i, a in enumerate(good):
        for j, b in enumerate(good):
            if i != j and a[2] == b[2] and len(a[1]) == len(b[1]) and units[i] @ units[j] >= threshold:
                links[a[0]] = links.get(a[0], 0) + 1
                x, y = root(a[0]), root(b[0])
                parent[max(x, y)] = min(x, y)
    return {r[0]: (links.get(r[0], 0), root(r[0]) if r[0] in parent else r[0]) for r in rows}


def make(rng, n=300, dim=16):
    base = rng.standard_normal((n, dim))
    rows = [[float(np.float32(x)) for x in v] for v in base]
    for i in range(60):  # copies at many distances
        rows.append([float(np.float32(x)) for x in base[i] + rng.standard_normal(dim) * rng.choice([0.02, 0.05, 0.1, 0.15])])
    center = rng.standard_normal(dim)
    rows += [[float(np.float32(x)) for x in center + rng.standard_normal(dim) * 0.05] for _ in range(150)]  # more than a list holds
    rows += [rows[3]] * 30
    return rows


def test_agrees_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddup, "BLOCK", 40)
    rng = np.random.default_rng(8)
    vectors = make(rng)
    ids = rng.permutation(len(vectors)).tolist()
    rows = [(i, v, k % 2, "x") for k, (i, v) in enumerate(zip(ids, vectors))]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] * 8, [float("inf")] + [1.0] * 15]
    rows += [(1000 + i, v, 0, "x") for i, v in enumerate(odd)] + [(1100, vectors[0], None, "x"), (1101, [1.0, 2.0], 0, "x"), (1102, [2.0, 4.0], 0, "x")]
    table = spark.createDataFrame(rows + [(None, vectors[0], 0, "x")], "vec_id long, embedding array<float>, label int, component string")
    out, recall = embeddup.near_duplicate_vectors(table)
    got = out.collect()
    want = brute(rows)
    assert len(got) == len(rows) + 1 and recall >= embeddup.RECALL
    same = [(r.n_links, r.component_id) == want[r.vec_id] for r in got if r.vec_id is not None]
    assert np.mean(same) > 0.99
    assert all(r.n_links <= want[r.vec_id][0] for r in got if r.vec_id is not None)
    assert all(r.kept == (r.component_id in (None, r.vec_id)) for r in got)
    none, recall = embeddup.near_duplicate_vectors(table.where("false"))
    assert none.count() == 0 and recall == 1.0


def test_links_across_full_groups(spark):
    """Two groups of 100 and 90 vectors, each nearer to its own than to any of the other, that link across all the same."""
    rng = np.random.default_rng(3)
    one = np.zeros(64)
    one[0] = 1
    other = one * 0.985
    other[1] = np.sqrt(1 - 0.985**2)
    near = lambda center, n: [(center + 0.0006 * rng.standard_normal(64)).tolist() for _ in range(n)]
    rows = [(i, v, 0) for i, v in enumerate(near(one, 100) + near(other, 90))]
    out, _ = embeddup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in out.collect()} == brute(rows)
    assert out.where("kept").count() == 1


def test_pairs_beside_a_hot_group(spark):
    """Lone pairs just above the threshold count as much as a group that has nearly all links."""
    rng = np.random.default_rng(5)
    lone = rng.standard_normal((2400, 64))
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    lone = unit(lone)
    aside = rng.standard_normal((200, 64))
    aside = unit(aside - (aside * lone[:200]).sum(1, keepdims=True) * lone[:200])
    twins = 0.9805 * lone[:200] + np.sqrt(1 - 0.9805**2) * aside
    hot = unit(lone[2399] + 0.003 * rng.standard_normal((1200, 64)))
    data = np.concatenate([lone, twins, hot])
    out, recall = embeddup.near_duplicate_vectors(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(data)], "vec_id long, embedding array<double>, label int"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert [got[2400 + i] for i in range(200)] == [(1, i) for i in range(200)] and recall == 1.0
    assert {got[i] for i in range(2600, 3800)} == {(1200, 2399)}
