import random

import numpy as np
import pytest

from macroloom.llm import decontaminate as d
from macroloom.llm.fmindex import FMIndex


def test_index_finds_what_scanning_finds():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 5, 3000)
    text[-1] = 0
    text[500:900] = 3
    index = FMIndex(text, 6)
    for width in (1, 2, 5, 12):
        starts = rng.integers(0, len(text) - width, 60)
        patterns = np.array([text[s : s + width] for s in starts if text[s : s + width].all()] + [[6] * width])
        low, high = index.ranges(patterns)
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(len(text) - width + 1) if (text[i : i + width] == p).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def brute(text, items):
    words = d.words_of((text or "").encode())
    hit, found = set(), set()
    for name, item in items:
        own = d.words_of((item or "").encode())
        width = min(10, len(own))
        for i in range(len(own) - width + 1 if width else 0):
            for j in range(len(words) - width + 1):
                if words[j : j + width] == own[i : i + width]:
                    hit.update(range(j, j + width))
                    found.add(name if name is None else str(name))
    return len(words), len(hit), sorted(found, key=lambda x: (x is None, x))


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_agrees_with_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(d, "SHARD_BYTES", 2000)
    rng = random.Random(4)
    vocabulary = ["the", "Of", "and", "été", "x1", "rare", "日本"]
    phrase = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, phrase(rng.choice([3, 9, 10, 14, 30]))) for i in range(12)] + [(3, phrase(12)), (50, None), (51, " .,"), (None, phrase(11))]
    items[1] = (1, items[0][1])
    texts = [phrase(rng.randint(0, 80)) for _ in range(40)] + [None, "", "!!"]
    for _ in range(30):
        whole = rng.choice(items[:12])[1].split()
        texts.append(phrase(5) + ", " + "-".join(whole[rng.randint(0, 2) :]).upper() + "\n" + phrase(5))
    texts += [texts[-1], (items[4][1] + " ") * 300, "so " + items[-1][1] + " on"]  # the last one is of an item without an id
    docs = spark.createDataFrame([(i if i else None, t, 7, 8) for i, t in enumerate(texts)], "doc_id long, text string, items int, n_hit int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id or 0: r for r in d.find_passages(docs, benchmark, block_bytes=block_bytes).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert (got[i].n_words, got[i].n_hit, list(got[i].items)) == brute(text, items)
        assert all(a.after < b.first for a, b in zip(got[i].spans, got[i].spans[1:]))
    assert d.find_passages(docs.where("false"), benchmark).count() == 0
    assert {r.n_hit for r in d.find_passages(docs, benchmark.where("false")).collect()} == {0}
