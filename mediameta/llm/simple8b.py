"""Simple-8b: varying counts of whole numbers in 64-bit words, coded and decoded with arrays.

The top 4 bits of a word select how many numbers of how many bits the other 60 hold. Selector 0 is a run of 240 zeros.
Selector 1 is the escape: the next word is one number as it stands, for those over 60 bits. Numbers come in blocks of
``BLOCK``; no word reaches over a block's end, so all blocks are coded side by side and each can be read alone.
"""

from __future__ import annotations

import numpy as np

# Numbers per word and bits per number, by selector.
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
RUN, ESCAPE = 0, 1

BLOCK = 1024


# The least level of bits that holds a number, by the greatest number of each level; the last one is the escape's.
_LEVELS = np.unique(BITS)
_UPPER = np.array([(1 << int(b)) - 1 for b in _LEVELS[:-1]], np.uint64)
# The same by the number itself, for small ones.
_SMALL = np.searchsorted(_UPPER, np.arange(1 << 16, dtype=np.uint64)).astype(np.uint8)


def _selectors(values: np.ndarray) -> np.ndarray:
    """For each position the selector of a word that begins there: the one that holds most numbers within the block.

    The greatest level in the next 1, 2, 4, ... numbers gives that of any window as the greater one of two.
    """
    n = len(values)
    blocks = -(-n // BLOCK)
    # Behind a block's end nothing is too wide: the rest of its last word is padding, which is not read.
    window = np.zeros((blocks, BLOCK + int(COUNTS.max())), np.uint8)
    full = np.zeros(blocks * BLOCK, np.uint8)
    full[:n] = _SMALL[values] if not n or values.max() < len(_SMALL) else np.searchsorted(_UPPER, values)
    window[:, :BLOCK] = full.reshape(blocks, BLOCK)
    chosen = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    size = 1
    for s in [*range(len(COUNTS) - 1, ESCAPE, -1), RUN]:
        count = int(COUNTS[s])
        while size * 2 <= count:
            window[:, :-size] = np.maximum(window[:, :-size], window[:, size:])
            size *= 2
        ok = np.maximum(window[:, :BLOCK], window[:, count - size : count - size + BLOCK]) <= np.searchsorted(_LEVELS, BITS[s])
        if s == RUN:
            # A run is of its full length.
            left = np.minimum(n - np.arange(blocks)[:, None] * BLOCK, BLOCK) - np.arange(BLOCK)[None]
            ok &= left >= count
        if not ok.any():
            # Words of more numbers need smaller ones in longer windows.
            break
        np.copyto(chosen, np.uint8(s), where=ok)
    return chosen.ravel()[:n]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and for each block the number of the word it begins with."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    chosen = _selectors(values)
    count = np.minimum(COUNTS[chosen], np.minimum((np.arange(n) // BLOCK + 1) * BLOCK, n) - np.arange(n))
    begins, at = [], np.arange(0, n, BLOCK)
    end = np.minimum(at + BLOCK, n)
    while len(at):
        begins.append(at)
        at = at + count[at]
        alive = at < end
        at, end = at[alive], end[alive]
    is_first = np.zeros(n, bool)
    is_first[np.concatenate(begins)] = True
    first = np.flatnonzero(is_first)
    selector = chosen[first].astype(np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    held = count[first]
    rows = np.flatnonzero((selector != RUN) & (selector != ESCAPE))
    for j in range(60):
        rows = rows[held[rows] > j]
        if not len(rows):
            break
        words[rows] |= values[first[rows] + j] << (BITS[selector[rows]] * j).astype(np.uint64)
    escaped = np.flatnonzero(selector == ESCAPE)
    place = np.arange(len(first)) + np.searchsorted(escaped, np.arange(len(first)))
    out = np.empty(len(first) + len(escaped), np.uint64)
    out[place] = words
    out[place[escaped] + 1] = values[first[escaped]]
    return out, place[np.searchsorted(first, np.arange(0, n, BLOCK))]


def decode(words: np.ndarray, n: int, blocks: np.ndarray) -> np.ndarray:
    """The ``n`` numbers of whole blocks, which begin at the words ``blocks``."""
    out = np.empty(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    # Words behind an escape are numbers. Escapes can stand behind each other, so look at them in order.
    raw = np.zeros(len(words) + 1, bool)
    for i in np.flatnonzero(selector == ESCAPE).tolist():
        if not raw[i]:
            raw[i + 1] = True
    head = np.flatnonzero(~raw[:-1])
    selector = selector[head]
    count = COUNTS[selector]
    # The last word of a block ends where the block does.
    begin = np.searchsorted(head, blocks)
    total = np.concatenate([[0], np.cumsum(count)])
    sums = np.diff(np.append(total[begin], total[-1]))
    sizes = np.minimum(BLOCK, n - np.arange(len(blocks)) * BLOCK)
    count[np.append(begin[1:], len(head)) - 1] -= sums - sizes
    start = np.concatenate([[0], np.cumsum(count)[:-1]])
    for s in np.unique(selector):
        rows = np.flatnonzero(selector == s)
        for j in range(int(COUNTS[s])):
            rows = rows[count[rows] > j]
            if not len(rows):
                break
            if s == RUN:
                got = np.zeros(len(rows), np.uint64)
            elif s == ESCAPE:
                got = words[head[rows] + 1]
            else:
                got = (words[head[rows]] >> np.uint64(BITS[s] * j)) & np.uint64((1 << int(BITS[s])) - 1)
            out[start[rows] + j] = got
    return out
