"""Word hashes of whole batches of texts, by numpy on the bytes of the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(n + 1, b, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        have = out[0], out[1]
        if n <= 4 << 20:
            _powers[base] = have
    return have[0][: n + 1], have[1][: n + 1]


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of values[start:end] for each pair; equal runs have equal hashes wherever they stand."""
    up, down = _power(_BASES[which], len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * up[:-1], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


#: Two primes, each with a base: the word hash is a polynomial in both.
_PRIMES = ((2147483647, 1103515245), (2147483629, 1664525001))

_residues: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _residue_powers(prime: int, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of a base and of its inverse modulo a prime, each run of them doubled from the one before."""
    have = _residues.get(prime)
    if have is None or len(have[0]) <= n:
        out = []
        for b in (base, pow(base, -1, prime)):
            a = np.ones(n + 1, np.uint64)
            k = 1
            while k <= n:
                more = min(k, n + 1 - k)
                a[k : k + more] = a[:more] * np.uint64(pow(b, k, prime)) % np.uint64(prime)
                k += more
            out.append(a)
        have = out[0], out[1]
        if n <= 4 << 20:
            _residues[prime] = have
    return have[0][: n + 1], have[1][: n + 1]


def words_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs data[start:end]: polynomials modulo two primes, scrambled.

    Modulo 2^64 a polynomial gives equal values for some regular texts, whatever
    its base; modulo primes no two texts are known to.
    """
    values = data.astype(np.uint64) + np.uint64(1)
    out = (end - start).astype(np.uint64) << np.uint64(1)
    for prime, base in _PRIMES:
        up, down = _residue_powers(prime, base, len(values))
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1] % np.uint64(prime), out=total[1:])
        h = (total[end] - total[start]) % np.uint64(prime) * down[start] % np.uint64(prime)
        out = mixed(out ^ h)
    return out


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end, first) of the words ``[^\\x20\\x09-\\x0D]+``: byte offsets in the
    joined texts, and for each text the number of its first word (one more at the end)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    step = np.diff(blank.astype(np.int8), prepend=np.int8(1))
    start, end = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.searchsorted(start, ends)]).astype(np.int64)
    return data, start, end, first


def batches(texts: list[str | None], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` characters; a longer text is a range of its own."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and total + n > size:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(texts):
        yield at, len(texts)
