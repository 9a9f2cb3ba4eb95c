"""Sets of word shingles, hashed to 64 bits in numpy over the bytes of many texts at once."""

import numpy as np

WIDTH = 5
_BASE, _ROLL = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, A-Z lower-cased, and the number of its text."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    inside = ~blank
    first = inside.copy()
    first[1:] &= blank[:-1]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.flatnonzero(inside)
    begin = np.flatnonzero(first[place])  # of each word among the characters inside words
    size = np.diff(np.append(begin, len(place)))
    char = raw[place].astype(np.uint64)
    char += np.where((char >= 65) & (char <= 90), np.uint64(32), np.uint64(0))
    power = powers(_BASE, int(size.max()))
    within = place - np.repeat(start, size)
    total = np.add.reduceat(char * power[within], begin)
    return mix(total + size.astype(np.uint64) * _ROLL), np.searchsorted(ends, start, "right")


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; fewer words than `width` are one shingle, no words are none."""
    words, owner = word_hashes(texts)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    counts = np.diff(bounds)
    roll = powers(_ROLL, width)
    n = max(0, len(words) - width + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(width):
        rolled += words[i:i + n] * roll[i]
    rolled = mix(rolled)
    out = []
    for at, count in zip(bounds[:-1].tolist(), counts.tolist()):
        if count >= width:
            out.append(np.unique(rolled[at:at + count - width + 1]))
        elif count:
            out.append(mix((words[at:at + count] * roll[:count]).sum(keepdims=True) + np.uint64(count)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
