"""Words of texts as 64-bit values, found and hashed on whole buffers.

A word's value is a polynomial in its bytes modulo 2^64, with a random number for each byte, then mixed. Equal words have equal
values; two different words agree with a chance of about 2^-64.
"""

import numpy as np

M64 = (1 << 64) - 1


def numbers(seed, n):
    """n fixed pseudo-random 64-bit values (splitmix)."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(x)


def mix(x):
    """Spreads the bits of 64-bit values; one-to-one."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: White space that separates words: space and tab to carriage return.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Everything in ASCII but digits and letters.
NO_WORD = bytes(i for i in range(128) if not chr(i).isalnum())


class Words:
    """Words of some texts: value, first and last byte + 1 in data, and for each text the place of its first word.

    texts: strings, taken as UTF-8, or bytes. separators: bytes between words; lower: whether A-Z count as a-z. Buffers are hashed at most `most` bytes at
    once, unless one word is longer.
    """

    BASE = 0xD6E8FEB86659FD93

    def __init__(self, texts, separators=SPACES, lower=False, most=1 << 20):
        encoded = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b" ".join(encoded) + b" "  # at least one byte
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1
        self.text_starts = np.cumsum(sizes) - sizes
        raw = np.frombuffer(self.data, np.uint8)
        self.starts, self.ends = self._edges(raw, separators)
        table = numbers(1, 256)
        if lower:
            table[65:91] = table[97:123]
        self.values = self._hash(raw, table, most)
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.counts = np.diff(np.append(self.first, len(self.starts)))

    def _edges(self, raw, separators):
        between = np.zeros(256, bool)
        between[list(separators)] = True
        sep = between[raw]
        edge = np.diff(sep.view(np.int8))
        starts = np.flatnonzero(edge == -1) + 1
        return starts if sep[0] else np.concatenate([[0], starts]), np.flatnonzero(edge == 1) + 1

    def _hash(self, raw, table, most):
        out, i, n = np.empty(len(self.starts), np.uint64), 0, len(self.starts)
        power = inverse = np.empty(0, np.uint64)
        while i < n:
            base = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, base + most, side="right")))
            size = int(self.ends[j - 1] - base)
            if len(power) < size:
                power = np.multiply.accumulate(np.full(size, self.BASE, np.uint64))
                inverse = np.multiply.accumulate(np.full(size, pow(self.BASE, -1, 1 << 64), np.uint64))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[raw[base:base + size]] * power[:size], dtype=np.uint64)])
            a, b = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = mix((total[b] - total[a]) * inverse[a])
            i = j
        return out

    def text_of(self, word):
        """The text that each of the given word places belongs to."""
        return np.searchsorted(self.first, word, side="right") - 1


def combine(values, length, base=0xA0761D6478BD642F):
    """Values of all runs of `length` consecutive words, the i-th starting at word i; runs may cross texts."""
    n = len(values) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out = out * np.uint64(base) + values[i:i + n]
    return mix(out + np.uint64(length))


def shingle_sets(words, length=5):
    """For each text the sorted distinct values of its runs of `length` words.

    A text of fewer words has its whole sequence as its only run; one without words has none.
    """
    runs = combine(words.values, length)
    out = []
    for start, n in zip(words.first, words.counts):
        if n >= length:
            out.append(np.unique(runs[start:start + n - length + 1]))
        elif n:
            out.append(combine(words.values[start:start + n], int(n)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
