"""Simple-8b: runs of small integers in 64-bit words, and its decoding with array operations.

A word has a selector in its top four bits and up to 60 bits of values, first value lowest. An
encoded block is: header, id offsets of its frames (``FRAME_WORDS`` words each), escaped values,
words. Any frame can be decoded without those before it.
"""

from __future__ import annotations

import struct

import numpy as np

# Fixed values of the coding: (values in a word, bits of each), by selector. Selector 0 is an
# escape: its word has the place of one value of 60 bits or more among the block's escaped values.
SELECTORS = [(1, 60), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]

FRAME_WORDS = 512
_HEADER = struct.Struct("<4sIQQII")
_COUNTS = np.array([n for n, _ in SELECTORS], np.int64)
_BY_COUNT = sorted(((n, bits, s) for s, (n, bits) in enumerate(SELECTORS) if s), key=lambda x: x[0])


def encode(values: np.ndarray) -> bytes:
    """One block; values are unsigned 64-bit integers at most."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    padded = np.concatenate([values, np.zeros(120, np.uint64)])
    selector = np.where(padded >= np.uint64(1 << 60), 0, 15).astype(np.uint8)
    # Half the width is half the time for what fits in it.
    largest, width = (padded.astype(np.uint32) if padded.max() < 1 << 32 else padded), 1
    for count, bits, s in _BY_COUNT[1:]:
        step = count - width
        while step > width:  # a window can grow by its own width at once
            largest, width, step = np.maximum(largest[:-width], largest[width:]), 2 * width, step - width
        largest, width = np.maximum(largest[: len(largest) - step], largest[step:]), count
        fits = largest < largest.dtype.type(1 << bits)
        if not fits.any():
            break
        np.putmask(selector[: len(fits)], fits, s)
    steps = _COUNTS[selector[:n]].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    at = np.array(starts, np.int64)
    chosen = selector[at].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    escaped = padded[at[chosen == 0]]
    words[chosen == 0] |= np.arange(len(escaped), dtype=np.uint64)
    for s in np.unique(chosen):
        count, bits = SELECTORS[s]
        if s and bits:
            where = np.nonzero(chosen == s)[0]
            part = padded[at[where][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
            words[where] |= np.bitwise_or.reduce(part, axis=1)
    frames = at[::FRAME_WORDS].astype(np.uint64)
    head = _HEADER.pack(b"S8BW", 1, n, len(words), len(frames), len(escaped))
    return head + frames.astype("<u8").tobytes() + escaped.astype("<u8").tobytes() + words.astype("<u8").tobytes()


def decode(block: bytes, first_frame: int = 0, last_frame: int | None = None) -> np.ndarray:
    """The values of a block, or of its frames from ``first_frame`` to before ``last_frame``."""
    magic, version, n, n_words, n_frames, n_escaped = _HEADER.unpack_from(block)
    if magic != b"S8BW" or version != 1:
        raise ValueError("not a block of this coding")
    numbers = np.frombuffer(block, "<u8", offset=_HEADER.size)
    frames, escaped, words = np.split(numbers, [n_frames, n_frames + n_escaped])
    last_frame = n_frames if last_frame is None else min(last_frame, n_frames)
    if first_frame >= last_frame:
        return np.zeros(0, np.uint64)
    begin = int(frames[first_frame])
    end = int(frames[last_frame]) if last_frame < n_frames else n
    words = words[first_frame * FRAME_WORDS : last_frame * FRAME_WORDS]
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[chosen]
    place = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(chosen):
        count, bits = SELECTORS[s]
        where = np.nonzero(chosen == s)[0]
        if s == 0:
            out[place[where]] = escaped[(words[where] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif bits:
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            part = (words[where][:, None] >> shifts) & np.uint64((1 << bits) - 1)
            out[place[where][:, None] + np.arange(count)] = part
    return out[: end - begin]
