import hashlib
import random
import zlib

import numpy as np

from macroloom.llm import periodic


def brute_lyndon(s):
    return [max(k for k in range(1, len(s) - i + 1) if all(s[i : i + k] < s[i + j : i + k] for j in range(1, k))) for i in range(len(s))]


def brute_runs(s, least, times):
    """Every stretch of equal letters at every distance, of equal stretches the one of the least distance."""
    found = {}
    for q in range(1, len(s) // times + 1):
        i = 0
        while i < len(s) - q:
            j = i
            while j < len(s) - q and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(least, times * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def test_lyndon_arrays_and_runs():
    rng = random.Random(12)
    for _ in range(600):
        strings = [[rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 3))]
        strings.append((strings[0][: rng.randint(1, 5)] * 12)[: rng.randint(0, 40)])
        flat = [0] + [x for s in strings for x in [*s, 0]]
        assert periodic.lyndon_array(flat) == [0] + [x for s in strings for x in [*brute_lyndon(s), 0]]
        least, times = rng.choice([(2, 2), (4, 2), (6, 3)])
        want = [(k, *r) for k, s in enumerate(strings) for r in brute_runs(s, least, times)]
        assert periodic.find_runs([np.array(s, int) for s in strings], least, times) == want


def test_runs_of_texts(monkeypatch):
    monkeypatch.setattr(periodic, "STRIDE", 8)
    rng = random.Random(13)
    for _ in range(200):
        words = [b"%d" % rng.randint(1, rng.randint(1, 3)) for _ in range(rng.randint(0, 30))]
        base = [b"%d" % rng.randint(1, 30) for _ in range(rng.randint(1, 30))]
        words = words + (base * 40)[: rng.randint(0, 140)] + words
        assert periodic.runs_of_texts([words, [], words]) == [brute_runs(words, 24, 3), [], brute_runs(words, 24, 3)]


def expected(key, text, repeat):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(key).encode()), len(words)
    if repeat and key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, 24, 3)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (len(runs), *shown, hashlib.sha256(listed.encode()).hexdigest(), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())


def test_documents(spark):
    rng = random.Random(14)
    texts = [None, "", " \n\t", "a " * 23, "a " * 24, "a b " * 12 + "a", "x" * 5000, "    é " * 30, "a\x00b " * 40, "a b " * 20 + "c " + "a b " * 20]
    texts += [" ".join(str(rng.randint(1, 400)) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    texts += ["w1 " * 3000 + "w2 " * 4000]  # long, and both runs touch
    table = [(i, t, 7) for i, t in enumerate(texts)] + [(None, "q " * 50, 7), (4, texts[4], 7), (4, "again " * 30, 7)]
    frame = spark.createDataFrame(table, "doc_id long, text string, start int")
    names = "n_runs start length period exponent_milli runs_sha256 collapsed".split()
    for repeat in (False, True):
        got = periodic.find_periodic(frame, repeat_tails=repeat).select("doc_id", *names).collect()
        assert sorted(map(tuple, got), key=str) == sorted(((i, *expected(i, t, repeat)) for i, t, _ in table), key=str)
    assert periodic.find_periodic(frame.where("false")).count() == 0
