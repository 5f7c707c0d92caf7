import random

import numpy as np

from macroloom.llm import repeats


def brute(rows):
    """Every 50-byte string of every document, one by one."""
    first = {}
    for i, text in rows:
        for p in range(len(text) - 49):
            s = text[p : p + 50]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, text in rows:
        gone = np.zeros(len(text) + 1, int)
        for p in range(len(text) - 49):
            if first[text[p : p + 50]] < i:
                gone[p : p + 50] = 1
        edges = np.diff(np.concatenate(([0], gone)))
        out[i] = (len(text), int(gone.sum()), int((edges == 1).sum()), bytes(b for b, g in zip(text, gone) if not g))
    return out


def test_agrees_with_brute_force(spark):
    rng = random.Random(9)
    word = lambda: rng.choice(["the", "of", "tion", "été", "日本", "a", "x", "and so on"])
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(10, 60)) for _ in range(6)] + ["ab" * 90, "a" * 120, "\n" * 60]
    texts = []
    for _ in range(60):
        parts = [prose(rng.randint(0, 40)) for _ in range(3)] + [p[rng.randint(0, 30) :] for p in rng.sample(passages, 2)]
        rng.shuffle(parts)
        texts.append("".join(parts))
    texts += [texts[3], texts[3], texts[4] + "!", "", None, "x" * 49, "y" * 50, "y" * 50, "y" * 300, texts[0][:50], texts[1][5:54]]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts)], "doc_id long, text string, first int, bucket string")
    got = repeats.remove_repeats(docs).collect()
    want = brute([(i, (t or "").encode()) for i, t in zip(ids, texts)])
    assert len(got) == len(texts)
    for r in got:
        removed = sum(s.after - s.first for s in r.spans)
        assert (r.n_bytes, removed, len(r.spans), bytes(r.kept)) == want[r.doc_id]
    assert repeats.remove_repeats(docs.where("false")).count() == 0


def test_null_ids_are_kept_whole(spark):
    docs = spark.createDataFrame([(None, "z" * 80), (1, "z" * 80), (2, "z" * 80)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, len(r.kept)) for r in repeats.remove_repeats(docs).collect()) == [(0, 80), (1, 80), (2, 0)]
