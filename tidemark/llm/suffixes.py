"""Suffix arrays by two-stage sorting, for strings of up to ``SPAN`` bytes.

Only suffixes smaller than their successors are sorted directly. The others follow from one scan over the buckets of first
bytes in ascending order: the predecessor of each suffix, if its byte is larger, comes next in the bucket of that byte. Then
the common prefixes of neighbours are compared. The order is exact to the first ``SPAN`` bytes, which is all that is asked.
"""

from __future__ import annotations

import numpy as np

SPAN = 50
DEPTH = 56


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each place whether its suffix is smaller than the next one; the end of the text is smaller than any byte."""
    n = len(text)
    # A place compares as the next place that is followed by another value.
    change = np.flatnonzero(text[1:] != text[:-1])
    out = np.zeros(n, bool)
    if len(change):
        up = text[change] < text[change + 1]
        at = np.searchsorted(change, np.arange(n - 1))
        inside = at < len(change)
        out[:-1][inside] = up[at[inside]]
    return out


def suffix_array(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Places of a byte text in the order of their suffixes, exact to ``depth`` bytes."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = smaller_than_next(text)
    direct = np.flatnonzero(kind)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(windows).view(f"S{depth}").ravel(), kind="stable")]
    firsts = text[direct]
    cuts = np.searchsorted(firsts, np.arange(257))
    arrived: list[list[np.ndarray]] = [[] for _ in range(256)]
    # The end of the text is the smallest suffix; its predecessor is the first to arrive.
    arrived[int(text[n - 1])].append(np.array([n - 1]))
    order = []
    for byte in range(256):
        members = arrived[byte]
        # Within a bucket a predecessor with the same byte follows all that came from smaller buckets, round by round.
        last = np.concatenate(members) if members else np.zeros(0, np.int64)
        rounds = [last]
        while len(last):
            before = last[last > 0] - 1
            last = before[(text[before] == byte) & ~kind[before]]
            if len(last):
                rounds.append(last)
        whole = np.concatenate(rounds + [direct[cuts[byte]:cuts[byte + 1]]])
        if not len(whole):
            continue
        order.append(whole)
        before = whole[whole > 0] - 1
        values = text[before]
        larger = values > byte
        before, values = before[larger], values[larger]
        by_value = np.argsort(values, kind="stable")
        before, values = before[by_value], values[by_value]
        for value, part in zip(*_runs(values, before)):
            arrived[value].append(part)
    return np.concatenate(order)


def _runs(values: np.ndarray, items: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(values):
        return [], []
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return values[np.r_[0, cuts]].tolist(), np.split(items, cuts)


def common_prefixes(text: np.ndarray, order: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Length, up to ``span``, of what each suffix in ``order`` has in common with the one before it; 0 for the first."""
    padded = np.concatenate([text, np.zeros(span, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, span)
    out = np.zeros(len(order), np.int64)
    for start in range(1, len(order), 1 << 16):
        a, b = order[start - 1:start - 1 + (1 << 16)], order[start:start + (1 << 16)]
        apart = windows[a[:len(b)]] != windows[b]
        out[start:start + len(b)] = np.where(apart.any(axis=1), apart.argmax(axis=1), span)
    return out


def shared_windows(texts: list[bytes], owners: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """For each text the starts of its ``span``-byte strings that also occur in a text of a smaller owner."""
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths) - lengths
    joined = np.frombuffer(b"".join(texts), np.uint8)
    if len(joined) < span:
        return [np.zeros(0, np.int64) for _ in texts]
    # Strings never run over the end of a text: only starts that leave a whole string are looked at below.
    order = suffix_array(joined)
    of = np.repeat(np.arange(len(texts)), lengths)
    fits = order - starts[of[order]] <= lengths[of[order]] - span
    order = order[fits]
    if not len(order):
        return [np.zeros(0, np.int64) for _ in texts]
    runs = np.flatnonzero(common_prefixes(joined, order, span) < span)
    least = np.minimum.reduceat(owners[of[order]], runs)
    least = np.repeat(least, np.diff(np.r_[runs, len(order)]))
    hit = order[least < owners[of[order]]]
    hit.sort()
    cuts = np.searchsorted(hit, starts)
    return [part - start for part, start in zip(np.split(hit, cuts[1:]), starts)]
