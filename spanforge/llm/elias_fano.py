"""Elias-Fano coding of monotone integers in NumPy arrays that can be memory-mapped; all look-ups take whole arrays."""

from __future__ import annotations

import json

import numpy as np

_ONE, _ALL, _SIX = np.uint64(1), np.uint64(2**64 - 1), np.uint64(63)
_PAIRS, _FOURS, _BYTES, _EACH, _TOPS = (np.uint64(x * (2**64 - 1) // 255) for x in (0x55, 0x33, 0x0F, 0x01, 0x80))
#: Place of the k-th one in a byte, by byte and k (8: it has fewer).
_BIT = np.array([[*(i for i in range(8) if byte >> i & 1), *[8] * 8][:8] for byte in range(256)], np.int64)
#: A position is kept for every so many ones, and zeros, of the upper bits, and their count before every so many words.
SAMPLE, WORDS = 64, 1


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """values: nondecreasing uint64 below universe. Lower bits are packed; upper bits are unary gaps."""
    n = len(values)
    low = max(0, int(universe).bit_length() - max(n, 1).bit_length())
    shift = np.uint64(low)
    highs = (values >> shift).astype(np.int64) if low < 64 else np.zeros(n, np.int64)
    last = int((universe - 1 if universe else 0) >> low)
    packed = np.zeros(n * low // 64 + 2, np.uint64)
    if low:
        lows, bit = values & (_ALL >> np.uint64(64 - low)), np.arange(n, dtype=np.uint64) * shift
        word, off = (bit >> np.uint64(6)).astype(np.int64), bit & _SIX
        np.bitwise_or.at(packed, word, lows << off)
        over = off + shift > 64
        np.bitwise_or.at(packed, word[over] + 1, lows[over] >> (np.uint64(64) - off[over]))
    at = highs + np.arange(n)
    upper = np.zeros((n + last + 1) // 64 + 2, np.uint64)
    np.bitwise_or.at(upper, at >> 6, _ONE << (at & 63).astype(np.uint64))
    zeros = np.arange(0, last + 1, SAMPLE)
    return {
        "meta": np.array([n, low, last], np.int64),
        "low": packed,
        "upper": upper,
        "ones": np.append(at[::SAMPLE], n + last).astype(np.int64),
        "zeros": np.append(zeros + np.searchsorted(highs, zeros, "right"), n + last).astype(np.int64),
        "before": np.concatenate([[0], np.cumsum(np.bitwise_count(upper), dtype=np.int64)])[::WORDS].astype(np.int32 if n < 1 << 31 else np.int64),
    }


class Monotone:
    def __init__(self, parts: dict[str, np.ndarray]) -> None:
        self.n, self.low, self.last = (int(x) for x in parts["meta"])
        self.packed, self.upper, self.ones, self.zeros, self.before = (parts[k] for k in ("low", "upper", "ones", "zeros", "before"))
        self.mask = _ALL >> np.uint64(64 - self.low) if self.low else np.uint64(0)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Bit position of the k-th one, or zero, of the upper bits."""
        flip, sample, size = np.uint64(0) if one else _ALL, self.ones if one else self.zeros, 64 * WORDS
        block, last = sample[k // SAMPLE] // size, sample[k // SAMPLE + 1] // size
        going = np.flatnonzero(block < last)
        while len(going):
            middle = (block[going] + last[going] + 1) >> 1
            count = self.before[middle] if one else middle * size - self.before[middle]
            on = count <= k[going]
            block[going] = np.where(on, middle, block[going])
            last[going] = np.where(on, last[going], middle - 1)
            going = going[block[going] < last[going]]
        left = k - (self.before[block] if one else block * size - self.before[block])
        word = block * WORDS
        x = self.upper[word] ^ flip
        count = np.bitwise_count(x).astype(np.int64)
        more = np.flatnonzero(left >= count)
        while len(more):
            left[more] -= count[more]
            word[more] += 1
            x[more] = self.upper[word[more]] ^ flip
            count[more] = np.bitwise_count(x[more])
            more = more[left[more] >= count[more]]
        # Within the word: prefix sums of its bytes' counts find the byte, a table the bit.
        sums = x - ((x >> _ONE) & _PAIRS)
        sums = (sums & _FOURS) + ((sums >> np.uint64(2)) & _FOURS)
        sums = ((sums + (sums >> np.uint64(4))) & _BYTES) * _EACH
        rank = left.astype(np.uint64)
        byte = np.bitwise_count((((rank * _EACH) | _TOPS) - sums) & _TOPS).astype(np.uint64) << np.uint64(3)
        rank -= ((sums << np.uint64(8)) >> byte) & np.uint64(255)
        return word * 64 + byte.astype(np.int64) + _BIT[((x >> byte) & np.uint64(255)).astype(np.int64), rank.astype(np.int64)]

    def _lower(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.low)
        word, off = (bit >> np.uint64(6)).astype(np.int64), bit & _SIX
        value = self.packed[word] >> off
        spill = np.flatnonzero(off + np.uint64(self.low) > 64)
        value[spill] |= self.packed[word[spill] + 1] << (np.uint64(64) - off[spill])
        return value & self.mask

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions i (all within 0..n-1)."""
        i = i.astype(np.int64)
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low)) | self._lower(i) if self.low < 64 else self._lower(i)

    def both(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at positions i and at those after them (all within 0..n-1)."""
        i = i.astype(np.int64)
        place = self._select(i, True)
        # The next one is mostly in the same word.
        later = self.upper[place >> 6] & ((_ALL << _ONE) << (place & 63).astype(np.uint64))
        after = (place & ~np.int64(63)) + np.bitwise_count((later & (~later + _ONE)) - _ONE).astype(np.int64)
        beyond = np.flatnonzero(later == 0)
        after[beyond] = self._select(i[beyond] + 1, True)
        low = np.uint64(self.low)
        value = lambda at, k: ((at - k).astype(np.uint64) << low) | self._lower(k) if self.low < 64 else self._lower(k)
        return value(place, i), value(after, i + 1)

    def find(self, x: np.ndarray) -> np.ndarray:
        """First position of each value, or -1: a jump to the values that share its upper bits, then bisection among them."""
        out = np.full(len(x), -1, np.int64)
        high = (x >> np.uint64(self.low)).astype(np.int64) if self.low < 64 else np.zeros(len(x), np.int64)
        live = np.flatnonzero((high >= 0) & (high <= self.last)) if self.n else np.zeros(0, np.int64)
        if not len(live):
            return out
        high = high[live]
        bit = np.zeros(len(live), np.int64)
        later = np.flatnonzero(high > 0)
        bit[later] = self._select(high[later] - 1, False) + 1
        # The values that share the upper bits are a run of ones; one that leaves its word ends at the next zero.
        off = bit & 63
        rest = self.upper[bit >> 6] >> off.astype(np.uint64)
        size = np.bitwise_count(rest & ~(rest + _ONE)).astype(np.int64)
        long = np.flatnonzero(off + size >= 64)
        size[long] = self._select(high[long], False) - bit[long]
        start, want = bit - high, x[live] & self.mask
        low, up = start, start + size
        some = np.flatnonzero(size > 0)
        live, want, low, up = live[some], want[some], low[some], up[some]
        end = up.copy()
        going = np.arange(len(live))
        while len(going):
            middle = (low[going] + up[going]) >> 1
            less = self._lower(middle) < want[going]
            low[going] = np.where(less, middle + 1, low[going])
            up[going] = np.where(less, up[going], middle)
            going = going[low[going] < up[going]]
        inside = np.flatnonzero(low < end)
        hit = inside[self._lower(low[inside]) == want[inside]]
        out[live[hit]] = low[hit]
        return out


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """One file of named arrays, each on a 64-byte boundary after a JSON header."""
    places, size = {}, 0
    for name, a in arrays.items():
        places[name] = (a.dtype.str, size, len(a))
        size += -(-a.nbytes // 64) * 64
    header = json.dumps(places).encode()
    header += b" " * (-(len(header) + 8) % 64)
    body = b"".join(a.tobytes() + bytes(-a.nbytes % 64) for a in arrays.values())
    return len(header).to_bytes(8, "little") + header + body


def unpack(data: np.ndarray) -> dict[str, np.ndarray]:
    """Views of a packed file given as (mapped) bytes."""
    size = int.from_bytes(data[:8].tobytes(), "little")
    places = json.loads(data[8 : 8 + size].tobytes())
    return {name: data[8 + size + at : 8 + size + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, at, n) in places.items()}


def named(prefix: str, parts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{prefix}.{k}": v for k, v in parts.items()}


def monotone(prefix: str, arrays: dict[str, np.ndarray]) -> Monotone:
    return Monotone({k: arrays[f"{prefix}.{k}"] for k in ("meta", "low", "upper", "ones", "zeros", "before")})
