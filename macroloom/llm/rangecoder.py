"""Context-mixing range coder for token ids: many independent blocks side by side.

A block starts from an empty model, so it can be decoded alone. Blocks of a segment are coded in
step, one token of each at a time, so that every operation is one on arrays of as many places as
there are blocks.

Every id has up to three predictions. Order 2 and order 1 name the id that followed the last two ids
or the last id before, with a confidence from 0 (none) to 3 that hits raise and a miss sets back. The
probability of an id is a mixture: a part of the range for the order-2 id, a part for the order-1 id,
and the rest divided by order-0 frequencies. How wide the parts are by confidence, and the order-0
frequencies of those ids that the others do not predict, stand at the head of the block.

The state of the coder has 48 bits and is held in doubles, which are exact up to 53: division, which
decoding is about, is then one on vectors.
"""

from __future__ import annotations

import struct

import numpy as np

from macroloom.llm.common import runs

#: Ids are below this.
HIGHEST = 1 << 16
#: Tokens of a block, and most of them.
BLOCK, MOST = 4096, 8192

_ONE, _WORD, _TOP = 1 << 16, float(1 << 32), float(1 << 48)
_HEAD = "<HHH6B"


def _turned(rows: np.ndarray) -> np.ndarray:
    """The transposed array, written in strips that fit into a cache."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for a in range(0, len(rows), 32):
        out[:, a : a + 32] = rows[a : a + 32].T
    return out


def _places(last: np.ndarray, older: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a block keeps the token that followed the last one, and the last two."""
    return last & mask, (last ^ older * 0x9E37) & mask


class Model:
    """Order-2 and order-1 predictions in ``lanes`` blocks while they are decoded. Tokens are ids + 1."""

    def __init__(self, lanes: int, bits: int):
        self.mask, self.base = (1 << bits) - 1, np.arange(lanes) << bits
        self.after1, self.after2 = (np.zeros(lanes << bits, np.int32) for _ in range(2))  # 4 * token + confidence
        self.last, self.older = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self) -> None:
        self.at1, self.at2 = (x + self.base for x in _places(self.last, self.older, self.mask))
        slot1, slot2 = self.after1.take(self.at1, mode="clip"), self.after2.take(self.at2, mode="clip")
        self.guess1, self.guess2 = slot1 >> 2, slot2 >> 2
        self.sure1, self.sure2 = slot1 & 3, slot2 & 3

    def learn(self, token: np.ndarray) -> None:
        fresh = token * 4 + 1
        self.after1[self.at1] = fresh + np.minimum(self.sure1, 2) * (self.guess1 == token)
        self.after2[self.at2] = fresh + np.minimum(self.sure2, 2) * (self.guess2 == token)
        self.older, self.last = self.last, token.astype(np.int64)


def predictions(tokens: np.ndarray, bits: int) -> np.ndarray:
    """What ``Model`` would predict in blocks (rows) whose tokens are known: confidences, and 16 * the part.

    Tokens after the same place of the model are brought together by sorting, so nothing is done step by step.
    """
    lanes, length = tokens.shape
    out = np.empty((lanes, length), np.uint8)
    step = np.arange(length, dtype=np.int32)
    for a in range(0, lanes, 64):
        rows = tokens[a : a + 64]
        before = np.pad(rows, ((0, 0), (2, 0)))
        found = []
        for place in _places(before[:, 1:-1].astype(np.int64), before[:, :-2].astype(np.int64), (1 << bits) - 1):
            order = np.sort(place.astype(np.int32) << 13 | step, axis=1)
            at = (order & MOST - 1) + (np.arange(len(rows)) * length)[:, None]
            token = rows.ravel().take(at, mode="clip")
            known = np.zeros(rows.shape, bool)  # the place has been used before
            known[:, 1:] = order[:, 1:] >> 13 == order[:, :-1] >> 13
            hit = known.copy()
            hit[:, 1:] &= token[:, 1:] == token[:, :-1]
            after = hit.astype(np.uint8)
            after[:, 1:] += hit[:, 1:] & hit[:, :-1]
            sure, guess = np.zeros(rows.shape, np.uint8), np.zeros(rows.shape, np.int32)
            sure[:, 1:] = (after[:, :-1] + 1) * known[:, 1:]
            guess[:, 1:] = token[:, :-1] * known[:, 1:]
            packed = np.empty(rows.size, np.int32)
            packed[at.ravel()] = (guess << 3 | sure << 1 | hit).ravel()
            found.append(packed.reshape(rows.shape))
        one, two = found
        sure1 = (one >> 1 & 3) * (one >> 3 != two >> 3)
        part = 2 - np.maximum(2 * (two & 1), one & 1)
        out[a : a + 64] = (two >> 1 & 3) + 4 * sure1 + 16 * part
    return out


def _parts(chances: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Widths of the order-2 and order-1 parts by block and confidences (order 1, order 2); the rest is above ``scale``.

    ``chances`` has three bytes, for the confidences 1 to 3, of order 2 and three of order 1.
    """
    most = _ONE - scale - 1
    two = np.pad(chances[:, :3].astype(np.int64), ((0, 0), (1, 0)))[:, None, :] + np.zeros((1, 4, 1), np.int64)
    one = np.pad(chances[:, 3:].astype(np.int64), ((0, 0), (1, 0)))[:, :, None]
    wide2 = most * two >> 8
    wide1 = np.where(one > 0, np.maximum((most - wide2) * one >> 8, 1), 0)
    return wide2, wide1


def _scaled(lane: np.ndarray, count: np.ndarray, lanes: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, width) of each id of the blocks in frequencies that end at ``scale``, none of them zero."""
    first = np.searchsorted(lane, np.arange(lanes + 1))
    kinds = np.diff(first)
    reached = np.concatenate(([0], np.cumsum(count)))
    total = np.diff(reached[first])
    rank = np.arange(len(lane)) - first[lane]
    before, after = reached[:-1] - reached[first[lane]], reached[1:] - reached[first[lane]]
    start = rank + before * (scale - kinds[lane]) // total[lane]
    return start, rank + 1 + after * (scale - kinds[lane]) // total[lane] - start


def _shape(tokens: int, block: int) -> tuple[int, int]:
    """Number of blocks and tokens of each; the last one is filled up."""
    if not 0 < block <= MOST:
        raise ValueError(f"a block has from 1 to {MOST} tokens")
    return -(-tokens // block), min(tokens, block)


def encode(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """The ids in consecutive blocks, each coded alone."""
    if len(ids) and (int(ids.max()) >= HIGHEST or int(ids.min()) < 0):
        raise ValueError(f"ids have to be from 0 to {HIGHEST - 1}")
    lanes, block = _shape(len(ids), block)
    if not lanes:
        return []
    padded = np.full(lanes * block, ids[-1] + 1, np.int32)
    padded[: len(ids)] = ids
    padded[: len(ids)] += 1
    padded = padded.reshape(lanes, block)
    bits = max(block - 1, 1).bit_length()
    scale = 1 << bits

    by_block = predictions(padded, bits)
    states, unsure = _turned(by_block), by_block >= 32
    lane = np.arange(lanes)
    seen = np.zeros(lanes * 48, np.int64)
    for a in range(0, block, 64):
        seen += np.bincount((lane * 48 + states[a : a + 64]).ravel(), minlength=lanes * 48)
    seen = seen.reshape(lanes, 3, 4, 4)  # by part and confidences
    two, one = seen.sum(2)[:, :, 1:], seen[:, 1:].sum(3)[:, :, 1:]
    rates = [(x[:, 0] + 0.4) / (x.sum(1) + 0.8) for x in (two, one)]
    chances = np.clip(np.rint(256 * np.concatenate(rates, axis=1)), 1, 255).astype(np.uint8)
    wide2, wide1 = _parts(chances, scale)
    first = wide2 + wide1
    starts = np.stack([np.zeros_like(first), wide2, first], 1).astype(np.float64).ravel()
    widths = np.stack([wide2, wide1, _ONE - first], 1).ravel() / scale

    # Order-0 frequencies of what is not predicted, and each token's place among them (all of it for the others).
    order = np.sort(np.where(unsure, padded << 13 | np.arange(block, dtype=np.int32), np.int32(1 << 30 | MOST)), axis=1)
    uses = unsure.sum(1)
    order, whose = order[order <= 1 << 30 | MOST - 1], np.repeat(lane, uses)
    ends = np.cumsum(uses)
    differs = np.diff(order >> 13, prepend=-1) != 0
    differs[ends - uses] = True
    new = np.flatnonzero(differs)
    count = np.diff(np.append(new, len(order)))
    owner, token = whose[new], order[new].astype(np.int64) >> 13
    begin, width = _scaled(owner, count, lanes, scale)
    places = np.full((block, lanes), scale, np.int32)
    places.ravel()[(order & MOST - 1).astype(np.int64) * lanes + whose] = np.repeat((begin << 14 | width).astype(np.int32), count)
    del order, whose, unsure
    heads = _write_tables(owner, token, count, chances, lanes)

    low, wide = np.zeros(lanes), np.full(lanes, _TOP)
    words, used = np.zeros(lanes * (block + 2), np.uint16), lane * (block + 2) + 1  # a word ahead for the carry of none
    of_lane = lane * 48
    for step in range(block):
        state = of_lane + states[step]
        part, place = widths.take(state, mode="clip"), places[step]
        shift = starts.take(state, mode="clip")
        before = place >> 14
        begin = np.floor(part * before)
        unit = np.floor(wide * (1 / _ONE))
        low += (shift + begin) * unit
        wide = (np.floor(part * (before + (place & 16383))) - begin) * unit
        _carry(low, words, used)
        full = wide < _WORD
        word = np.floor(low * (1 / _WORD))
        words[used] = word
        more = full * (_ONE - 1.0) + 1
        low -= word * full * _WORD
        low *= more
        wide *= more
        used += full
    low += _WORD - 1  # one word more names a number inside what is left
    _carry(low, words, used)
    words[used] = np.floor(low / _WORD)
    words = words.astype("<u2").reshape(lanes, block + 2)
    used -= lane * (block + 2)
    return [heads[i] + words[i, 1 : n + 1].tobytes() for i, n in enumerate(used.tolist())]


def _carry(low: np.ndarray, words: np.ndarray, used: np.ndarray) -> None:
    over = np.flatnonzero(low >= _TOP)
    low[over] -= _TOP
    back = used[over] - 1
    while len(back):  # a carry runs back through words of ones
        words[back] += np.uint16(1)
        back = back[words[back] == 0] - 1


def _write_tables(owner: np.ndarray, token: np.ndarray, count: np.ndarray, chances: np.ndarray, lanes: int) -> list[bytes]:
    """Heads of blocks: number of ids, of their uses and of the bits for gaps, chances; gaps by 256 and uses in unary, gaps' last bytes."""
    first = np.searchsorted(owner, np.arange(lanes + 1))
    gap = np.where(np.diff(owner, prepend=-1) > 0, token, np.diff(token, prepend=0)) - 1
    kinds, uses = np.diff(first), np.diff(np.concatenate(([0], np.cumsum(count)))[first])
    unary = np.cumsum((gap >> 8) + 1)
    gaps = np.diff(np.concatenate(([0], unary))[first])
    size = -(-(gaps + uses) // 8)
    at = 8 * (np.cumsum(size) - size)
    bits = np.zeros(8 * int(size.sum()), bool)
    bits[unary - 1 + np.repeat(at - (np.cumsum(gaps) - gaps), kinds)] = True
    bits[np.cumsum(count) - 1 + np.repeat(at + gaps - (np.cumsum(uses) - uses), kinds)] = True
    packed, low, ends = np.packbits(bits).tobytes(), (gap & 255).astype(np.uint8).tobytes(), np.cumsum(size).tolist()
    rows = zip(kinds.tolist(), uses.tolist(), gaps.tolist(), chances.tolist(), [0, *ends], ends, first.tolist(), first[1:].tolist())
    return [struct.pack(_HEAD, k, u, g, *c) + packed[a:b] + low[x:y] for k, u, g, c, a, b, x, y in rows]


def _read_tables(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(block, token, uses) of each id, chances, and where the words of each block begin: what ``_write_tables`` wrote."""
    skip = struct.calcsize(_HEAD)
    heads = np.array([struct.unpack_from(_HEAD, b) for b in blocks], np.int64)
    kinds, uses, gaps = heads[:, 0], heads[:, 1], heads[:, 2]
    size = -(-(gaps + uses) // 8)
    ends = (skip + size).tolist()
    bits = np.unpackbits(np.frombuffer(b"".join(b[skip:n] for b, n in zip(blocks, ends)), np.uint8))
    low = np.frombuffer(b"".join(b[n : n + k] for b, n, k in zip(blocks, ends, kinds.tolist())), np.uint8)
    at = 8 * (np.cumsum(size) - size)
    high = np.diff(np.flatnonzero(bits[runs(at, gaps)]), prepend=-1) - 1
    count = np.diff(np.flatnonzero(bits[runs(at + gaps, uses)]), prepend=-1)
    gap = (high << 8) + low + 1
    owner = np.repeat(np.arange(len(blocks)), kinds)
    reached = np.concatenate(([0], np.cumsum(gap)))
    token = reached[1:] - np.repeat(reached[np.cumsum(kinds) - kinds], kinds)
    return owner, token, count, heads[:, 3:], (skip + size + kinds).tolist()


def decode(blocks: list[bytes], tokens: int, highest: int, block: int = BLOCK) -> np.ndarray:
    """The ids that ``encode`` took; ``highest`` is above all of them."""
    lanes, block = _shape(tokens, block)
    if not lanes:
        return np.zeros(0, np.int64)
    bits = max(block - 1, 1).bit_length()
    scale, lane = 1 << bits, np.arange(lanes)
    owner, token, count, chances, places = _read_tables(blocks)
    if int(token.max()) > highest:
        raise ValueError(f"a block has ids from {highest} on")
    begin, width = _scaled(owner, count, lanes, scale)
    table = np.repeat(token << 28 | begin << 14 | width, width)  # by block, one entry for each unit of frequency
    wide2, wide1 = _parts(chances, scale)
    wide2, first = wide2.astype(np.float64).ravel(), (wide2 + wide1).astype(np.float64).ravel()

    length = max(len(b) - a for a, b in zip(places, blocks)) // 2 + 4
    words = np.zeros((lanes, length), np.uint16)
    for i, (a, b) in enumerate(zip(places, blocks)):
        words[i, : (len(b) - a) // 2] = np.frombuffer(b, "<u2", offset=a)
    ahead = words[:, 0] * _WORD + words[:, 1] * float(_ONE) + words[:, 2]
    words, used, wide = words.ravel(), lane * length + 3, np.full(lanes, _TOP)
    model, out = Model(lanes, bits), np.empty((block, lanes), np.int32)
    sixteen, rows = lane * 16, lane << bits
    for step in range(block):
        model.predict()
        state = sixteen + model.sure2 + 4 * model.sure1 * (model.guess1 != model.guess2)
        two, reach = wide2.take(state, mode="clip"), first.take(state, mode="clip")
        rest = _ONE - reach
        unit = np.floor(wide * (1 / _ONE))
        value = np.floor(ahead / unit)
        none, second = value >= reach, value < two
        inside = np.floor(((value - reach) * scale + (scale - 1)) / rest).astype(np.int64)
        entry = table.take(rows + np.maximum(inside, 0), mode="clip")
        token = np.where(none, (entry >> 28).astype(np.int32), np.where(second, model.guess2, model.guess1))
        rest *= 1 / scale
        before = entry >> 14 & 16383
        begin = np.floor(rest * before)
        end = np.floor(rest * (before + (entry & 16383)))
        start = np.where(none, reach + begin, two * (1 - second))
        wide = unit * np.where(none, end - begin, np.where(second, two, reach - two))
        ahead -= start * unit
        full = wide < _WORD
        more = full * (_ONE - 1.0) + 1
        wide *= more
        ahead *= more
        ahead += words.take(used, mode="clip") * full
        used += full
        model.learn(token)
        out[step] = token
    return _turned(out).ravel()[:tokens] - 1
