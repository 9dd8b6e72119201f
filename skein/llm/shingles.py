"""Word shingles as sets of 62-bit hashes, computed for many texts at once.

A shingle is a stretch of the normalised text (words joined by single spaces), so its
hash is a difference of prefix sums of a polynomial over the bytes; no shingle string is
ever built. The polynomial is taken modulo two primes (a power of two as the modulus
would make some words collide whatever the base), at bases drawn anew by ``fresh_key`` for
each run, so that nobody can plant texts that collide. Long texts are cut into pieces that
overlap by one shingle less a word.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np

from skein.llm.common import keeps

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Below 2^31, so that products fit into 64 bits and sums over CHUNK bytes do.
PRIMES = (2_147_483_647, 2_147_483_629)
KEY = (1_234_567_891, 987_654_323)
#: Bytes that are hashed at once.
CHUNK = 1 << 19
_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
keeps("shingles", _powers.clear)


def fresh_key() -> tuple[int, int]:
    """Bases that nobody could know before."""
    return tuple(secrets.randbelow(p - 1_000_000) + 500_000 for p in PRIMES)


def _powers_of(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return out.astype(np.uint32)


def _tables(base: int, prime: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse."""
    found = _powers.get((base, prime))
    if found is None or len(found[0]) < n:
        if len(_powers) > 3:
            _powers.clear()
        size = max(n, CHUNK + 65536)
        found = _powers[base, prime] = _powers_of(base, prime, size), _powers_of(pow(base, -1, prime), prime, size)
    return found


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words without ASCII white space, A-Z lower-cased."""
    return text.encode().translate(_LOWER).split() if text else []


def _hashes(pieces: list[tuple[int, bytes]], size: int, key: tuple[int, int]) -> Iterator[tuple[int, np.ndarray]]:
    """(number, hashes) of normalised pieces, none empty."""
    blob = b"\n".join([p for _, p in pieces])
    arr = np.frombuffer(blob, np.uint8)
    sums = []
    for base, prime in zip(key, PRIMES):
        power, back = _tables(base, prime, len(arr) + 1)
        prefix = np.zeros(len(arr) + 1, np.uint64)
        np.cumsum((arr.astype(np.uint64) + np.uint64(1)) * power[: len(arr)], out=prefix[1:])
        sums.append((prefix, back, np.uint64(prime)))
    cuts = np.flatnonzero((arr == 32) | (arr == 10))
    starts, ends = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(arr)]))
    last = np.concatenate((np.flatnonzero(arr[cuts] == 10), [len(starts) - 1]))  # each piece's last word
    first = np.concatenate(([0], last[:-1] + 1))
    for (number, _), a, b in zip(pieces, first.tolist(), last.tolist()):
        if b - a + 1 < size:
            s, e = starts[a : a + 1], ends[b : b + 1]
        else:
            s, e = starts[a : b - size + 2], ends[a + size - 1 : b + 1]
        one, two = ((prefix[e] - prefix[s]) % prime * back[s] % prime for prefix, back, prime in sums)
        yield number, _mix(one << np.uint64(32) | two)


def shingle_sets(texts: list[str | None], size: int, key: tuple[int, int] = KEY) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending. A text of fewer words, but not none, is one shingle."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    pending: list[tuple[int, bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        for number, h in _hashes(pending, size, key):
            found[number].append(h)
        pending.clear()
        held = 0

    for number, text in enumerate(texts):
        words = words_of(text)
        if not words:
            continue
        joined = b" ".join(words)
        if len(joined) <= CHUNK:
            parts = [joined]
        else:
            step = max(size, len(words) * (CHUNK // 2) // len(joined))
            parts = [b" ".join(words[k : k + step + size - 1]) for k in range(0, max(1, len(words) - size + 1), step)]
        for part in parts:
            if pending and held + len(part) > CHUNK:
                flush()
            pending.append((number, part))
            held += len(part) + 1
    if pending:
        flush()
    out = []
    for parts in found:
        h = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        out.append(h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h)
    return out


def set_id(hashes: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)
