"""64-bit hashes of the words of texts, in bulk over byte buffers.

Two different words share a hash with a chance of 2**-64. What depends on more
than single pairs of words being told apart uses two hashes.
"""

from __future__ import annotations

import ctypes
import hashlib
import sys

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes that are hashed at once.
CHUNK = 1 << 19
#: Longer spans are hashed one by one.
LONG_SPAN = 256
#: For n bytes of a lane, what keeps them.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def lean() -> None:
    """Let a Python worker hand freed arrays back: workers live on and share an executor's memory.

    The C library else keeps what it once had of blocks of up to 32 MB.
    """
    if sys.platform == "linux":
        libc = ctypes.CDLL(None)
        if hasattr(libc, "mallopt"):
            libc.mallopt(-3, 8 << 20)  # M_MMAP_THRESHOLD
            libc.mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD


def settle() -> None:
    """At the end of a task: hand back what is free."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(ctypes.CDLL(None), "malloc_trim"):
        ctypes.CDLL(None).malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lanes_of(data) -> np.ndarray:
    """The eight bytes from each place of a buffer, as numbers; eight more bytes must follow what is read."""
    return np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))


def span_hashes(data, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each pair; eight bytes must follow the last span.

    Eight bytes are mixed in at a time, each step a bijection of the state, so
    that no pattern of letters makes two spans equal but by a chance of 2**-64.
    """
    lanes, sizes = lanes_of(data), ends - starts
    h = mix64(sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D))
    if not len(h):
        return h
    h = mix64(h ^ (lanes[starts] & _MASK[np.minimum(sizes, 8)]))
    at, done = np.flatnonzero((sizes > 8) & (sizes <= LONG_SPAN)), 8
    while len(at):
        left = np.minimum(sizes[at] - done, 8)
        h[at] = mix64((h[at] * np.uint64(0x9E3779B97F4A7C15)) ^ (lanes[starts[at] + done] & _MASK[left]))
        done += 8
        at = at[sizes[at] > done]
    for i in np.flatnonzero(sizes > LONG_SPAN).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return h


def equal_spans(a, starts_a: np.ndarray, sizes_a: np.ndarray, b, starts_b: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Whether a[start:start + size] is the same bytes as its counterpart in b; eight bytes must follow in both."""
    x, y = lanes_of(a), lanes_of(b)
    same = sizes_a == sizes_b
    at, done = np.flatnonzero(same & (sizes_a > 0)), 0
    while len(at) and done < LONG_SPAN:
        mask = _MASK[np.minimum(sizes_a[at] - done, 8)]
        ok = (x[starts_a[at] + done] & mask) == (y[starts_b[at] + done] & mask)
        same[at[~ok]] = False
        done += 8
        at = at[ok & (sizes_a[at] > done)]
    for i in at.tolist():
        same[i] = bytes(a[starts_a[i] : starts_a[i] + sizes_a[i]]) == bytes(b[starts_b[i] : starts_b[i] + sizes_b[i]])
    return same


def run_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive values, put together from runs of powers of two."""
    if len(values) < n:
        return np.empty(0, np.uint64)
    out, length, power, part = None, 0, values, 1
    while True:
        if n & part:
            # ``out`` covers the first ``length`` of each run, ``power`` any run of ``part``.
            out = power if out is None else mix64(out[: len(values) - length - part + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + mix64(power[length:] + np.uint64(part)))
            length += part
            if length == n:
                return out
        power = mix64(power[:-part] * np.uint64(0x9E3779B97F4A7C15) + mix64(power[part:] + np.uint64(part)))
        part *= 2


def _hash_buffer(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a buffer that ends with a blank, and where they start."""
    b = np.frombuffer(data + b"\n" * 8, np.uint8)
    space = _SPACE[b]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(b) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    return span_hashes(_LOWER[b] if lower else b, starts, ends), starts


def _cuts(raw: bytes) -> list[bytes]:
    """A long text in parts of about CHUNK bytes, cut after a blank."""
    parts, at = [], 0
    while len(raw) - at > CHUNK:
        near = raw[at + CHUNK : at + 2 * CHUNK]
        skip = next((i for i, c in enumerate(near) if _SPACE[c]), None)
        if skip is None:
            break
        parts.append(raw[at : at + CHUNK + skip + 1])
        at += CHUNK + skip + 1
    return [*parts, raw[at:]]


def raw_slice(column, start: int, n: int) -> list[bytes]:
    """Bytes of rows of an Arrow binary column."""
    return [x.as_buffer().to_pybytes() for x in column.slice(start, n)]


def word_hashes(raws: list[bytes], lower: bool = False) -> list[np.ndarray]:
    """For each text its words' hashes in order. Words are runs of other bytes than blanks."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(raws)
    group: list[int] = []
    held = 0

    def flush() -> None:
        if group:
            data = b"".join(x for i in group for x in (raws[i], b"\n"))
            hashes, starts = _hash_buffer(data, lower)
            ends = np.cumsum([len(raws[i]) + 1 for i in group])
            at = np.concatenate([[0], np.searchsorted(starts, ends)])
            for k, i in enumerate(group):
                out[i] = hashes[at[k] : at[k + 1]]
            group.clear()

    for i, raw in enumerate(raws):
        if len(raw) > CHUNK:
            out[i] = np.concatenate([_hash_buffer(part + b"\n", lower)[0] for part in _cuts(raw)])
            continue
        if held + len(raw) > CHUNK:
            flush()
            held = 0
        group.append(i)
        held += len(raw) + 1
    flush()
    return out
