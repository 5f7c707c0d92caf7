"""Runs of words: Lyndon arrays by grouping suffixes under both orders, roots extended to runs."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from macroloom.llm.common import portions

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 24, 3
#: Any so many consecutive words of a run stand in it a period earlier or later again: of 24 words with a
#: period of at most 8, and of three periods of 9 words or more, every window of 9 has such a neighbour.
WINDOW = 9
#: Longest stretch of letters with a name of its own; longer extensions go on in steps of it.
STRIDE = 1 << 12

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def lyndon_array(letters: Sequence[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place of ``letters``; 0 marks ends of strings.

    The first phase of the grouping suffix sorter: suffixes that start with the same Lyndon word u
    are a group, groups are in order of their words, and the highest group left is settled next. For
    each of its suffixes the nearest place before it that is not settled, j, is sought; if l of them
    lead to j, the word of j's group is continued by u l times, so j moves to a group of its own right
    after its old one. What a group's word is when it is settled cannot grow any more.
    """
    n = len(letters)
    members: list[list[int]] = []
    length: list[int] = []
    below: list[int] = []  # the next lower group
    above: list[int] = []
    group, before = [0] * n, list(range(n))  # a settled place points to an earlier one
    last = 0
    for i in sorted(range(n), key=letters.__getitem__):
        if letters[i] != last or not members:
            last = letters[i]
            members.append([])
            length.append(1 if last else 0)
            below.append(len(members) - 2)
            above.append(len(members))
        members[-1].append(i)
        group[i] = len(members) - 1
    above[-1] = -1
    out = [0] * n
    top = len(members) - 1
    while top >= 0 and length[top]:
        word = length[top]
        places = [i for i in members[top] if group[i] == top]
        for i in places:
            out[i] = word
            before[i] = i - 1
        led: dict[int, int] = {}
        for i in places:
            j = i
            while j >= 0 and before[j] != j:
                step = before[j]
                before[j] = before[step] if step >= 0 else step
                j = step if step < 0 else before[j]
            if j >= 0 and letters[j]:
                led[j] = led.get(j, 0) + 1
        moved: dict[int, dict[int, list[int]]] = {}
        for j, times in led.items():
            moved.setdefault(times, {}).setdefault(group[j], []).append(j)
        for times in sorted(moved, reverse=True):
            for old, some in moved[times].items():
                new, higher = len(members), above[old]
                members.append(some)
                length.append(length[old] + times * word)
                below.append(old)
                above.append(higher)
                above[old] = new
                if higher >= 0:
                    below[higher] = new
                for j in some:
                    group[j] = new
        members[top] = []
        top = below[top]
    return out


class Extensions:
    """Longest common extensions in ``letters``, by exact names of all stretches of 1, 2, 4, ... letters."""

    def __init__(self, letters: np.ndarray, longest: int):
        self.names = [letters.astype(np.int32)]
        width = 1
        while 2 * width <= min(longest, STRIDE):
            old = self.names[-1].astype(np.int64)
            _, new = np.unique(old[:-width] * (int(old.max()) + 1) + old[width:], return_inverse=True)
            self.names.append(new.astype(np.int32))
            width *= 2

    def _extend(self, i: np.ndarray, j: np.ndarray, sign: int) -> np.ndarray:
        far = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, width = self.names[k], 1 << k
            left = np.arange(len(i))
            while len(left):
                step = far[left] if sign > 0 else -far[left] - width
                a, b = i[left] + step, j[left] + step
                fits = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(name))
                equal = fits & (name[np.where(fits, a, 0)] == name[np.where(fits, b, 0)])
                left = left[equal]
                far[left] += width
                if k < len(self.names) - 1:
                    break
        return far

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of letters from i and from j on that are equal."""
        return self._extend(i, j, 1)

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of letters before i and before j that are equal."""
        return self._extend(i, j, -1)


def find_runs(strings: Sequence[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int, int]]:
    """(string, start, length, period) of all runs of ``least`` letters and ``times`` periods, in order. Letters are whole numbers from 1.

    Every run has a Lyndon root, which under one of the two orders of letters is the longest Lyndon
    word at its place. So both Lyndon arrays name all roots; each is extended to both sides as far as
    the letters a period apart are equal.
    """
    strings = [np.asarray(s, np.int64) for s in strings]
    sizes = np.array([len(s) for s in strings], np.int64)
    if not sizes.sum():
        return []
    starts = np.cumsum(sizes + 1) - sizes
    letters = np.zeros(int(sizes.sum()) + len(strings) + 1, np.int64)
    owner = np.full(len(letters), -1)
    for k, (start, s) in enumerate(zip(starts, strings)):
        letters[start : start + len(s)] = s
        owner[start : start + len(s)] = k
    inside = letters > 0
    flipped = np.where(inside, letters.max() + 1 - letters, 0)
    at, period = [], []
    for order in (letters, flipped):
        found = np.array(lyndon_array(order.tolist()), np.int64)
        whole = np.flatnonzero(inside & (found * times <= sizes[owner]))
        at.append(whole)
        period.append(found[whole])
    roots = np.unique(np.stack([np.concatenate(at), np.concatenate(period)], 1), axis=0)
    # Ends of strings are letters of their own, so that nothing extends over them.
    alone = np.where(inside, letters, letters.max() + 1 + np.arange(len(letters)))
    _, alone = np.unique(alone, return_inverse=True)
    extend = Extensions(alone, int(sizes.max()))
    i, p = roots[:, 0], roots[:, 1]
    left = extend.backward(i, i + p)
    length = left + p + extend.forward(i, i + p)
    keep = (length >= least) & (length >= times * p)
    runs = np.unique(np.stack([owner[i], i - left - starts[owner[i]], length, p], 1)[keep], axis=0)
    return list(map(tuple, runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))].tolist()))


def recurring(texts: Sequence[list[bytes]]) -> list[tuple[int, int, int]]:
    """(text, first word, after the last) of stretches that can hold runs.

    WINDOW consecutive words of a run stand in its text a period earlier or later too, so a run lies
    within consecutive windows that recur in their text. Equal windows have equal hashes, so nothing
    is lost; what unequal ones of one hash add is told apart by the letters themselves.
    """
    sizes = np.array([len(w) for w in texts], np.int64)
    total = int(sizes.sum())
    if total < LEAST:
        return []
    words = np.fromiter((hash(w) for some in texts for w in some), np.int64, total).view(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    names = (owner[: total - WINDOW + 1].astype(np.uint64) + np.uint64(1)) * _ODD[0]
    for k in range(WINDOW):
        names ^= words[k : total - WINDOW + 1 + k]
        names *= _ODD[1 + k % 2]
        names ^= names >> np.uint64(29)
    places = np.flatnonzero(owner[: len(names)] == owner[WINDOW - 1 :])
    names = names[places]
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    twice = np.zeros(len(names), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    places = places[twice]
    if not len(places):
        return []
    new = np.concatenate(([True], (places[1:] != places[:-1] + 1) | (owner[places[1:]] != owner[places[:-1]])))
    first = places[new]
    after = places[np.append(np.flatnonzero(new)[1:] - 1, len(places) - 1)] + WINDOW
    base = np.cumsum(sizes) - sizes
    long = after - first >= LEAST
    return [(int(t), int(a - base[t]), int(b - base[t])) for t, a, b in zip(owner[first][long], first[long], after[long])]


def runs_of_texts(texts: Sequence[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every text, given as words, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    stretches = recurring(texts)
    numbers: dict[bytes, int] = {}
    strings = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in texts[t][a:b]]) for t, a, b in stretches]
    for k, start, length, period in find_runs(strings):
        text, first, _ = stretches[k]
        out[text].append((first + start, length, period))
    return out


def made_periodic(key: object, words: list[bytes]) -> list[bytes]:
    """The words of the row of a tenth of all keys with a tail that repeats; those of other rows as they are."""
    h = zlib.crc32(str(key).encode())
    if h % 10 or not words or key is None:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _summary(runs: list[tuple[int, int, int]], words: list[bytes]) -> tuple:
    best = None
    for run in runs:  # in order, so that the first of equal exponents stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = words if not runs else [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    return best, hashlib.sha256(listed).hexdigest(), b" ".join(kept)


RUN_COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed string, runs array<struct<start:long,length:long,period:long>>"


def find_periodic(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", repeat_tails: bool = False) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed, runs) of every document.

    Words are what stands between ASCII white space. A run is a stretch of at least LEAST words and
    three periods, period being the smallest, that neither neighbouring word continues; ``runs`` are
    all of them by start, then period, and the next columns describe the one of the greatest exact
    length / period (the first of equal ones; null where there is none). ``collapsed`` are the words
    joined by spaces without those that a run holds after its first period. ``repeat_tails`` puts the
    repeating tails of ``made_periodic`` into a tenth of the documents before.

    Documents are judged one by one in the tasks that read them, so nothing is shuffled. Null and
    empty texts have no words. A row with a null id is judged like any other; its tail is left as it
    is. Repeated rows are judged alike. Other columns are ignored.
    """
    kind = dict(docs.dtypes)[id_column]
    rows = docs.selectExpr(f"`{id_column}` AS id", f"CAST(`{text_column}` AS string) AS text")
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1):
            ids = batch.column(0).to_pylist()
            texts = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            if repeat_tails:
                texts = [made_periodic(i, w) for i, w in zip(ids, texts)]
            runs = runs_of_texts(texts)
            made = [_summary(r, w) for r, w in zip(runs, texts)]
            best = [b or (None, None, None) for b, _, _ in made]
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    long([len(r) for r in runs]),
                    *(long([b[k] for b in best]) for k in range(3)),
                    long([None if b[0] is None else 1000 * b[1] // b[2] for b in best]),
                    pa.array([m[1] for m in made], pa.string()),
                    pa.array([m[2].decode("utf-8", "replace") for m in made], pa.string()),
                    pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs], run_type),
                ],
                names=["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed", "runs"],
            )

    return rows.mapInArrow(judge, f"id {kind}, {RUN_COLUMNS}").withColumnRenamed("id", id_column)
