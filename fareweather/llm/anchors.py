"""Repeated windows in sequences, found at content-defined anchors.

Sequences (bytes or words) are cut into phrases where a rolling fingerprint of a few
symbols hits. Every window of ``length`` symbols is filed under its first anchor, by
its distance from it: the windows of one class of distances share all symbols from
the least distance before the anchor to what the farthest window reaches after it,
and the fingerprint of these is their key. Equal windows have the same first anchor
at the same distance, so the same key: only rows that share a key need to be looked
at. Windows without an anchor are filed by a second, denser set of anchors, and those
without one there under themselves. A row stands for all windows of one class at an
anchor; ``context`` is the fingerprint of all their symbols, so equal contexts are
equal windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fareweather.llm.text import mix, powers, ranges, stretch

_U = np.uint64
_K1, _K2 = _U(0x9FB21C651E98DF25), _U(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Scheme:
    """``length`` of a window, ``span`` of an anchor's fingerprint; one in ``rates[k]``
    positions is an anchor of set k; ``cuts`` part the distances into classes."""

    length: int
    span: int
    rates: tuple[int, ...]
    cuts: tuple[int, ...]


def prefix_of(values: np.ndarray) -> np.ndarray:
    """Prefix sums of fingerprints of a sequence of 64-bit values."""
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


@dataclass
class Rows:
    """``at`` is the anchor; windows start at ``at - t`` for t from ``low`` to ``high``."""

    key: np.ndarray
    context: np.ndarray
    text: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


def filed(prefix: np.ndarray, offsets: np.ndarray, s: Scheme) -> Rows:
    """Rows for all windows of the texts between ``offsets``; positions are absolute."""
    begin, end, owner = offsets[:-1], offsets[1:], np.arange(len(offsets) - 1)
    out: list[tuple] = []
    for tier, rate in enumerate(s.rates):
        begin, end, owner = _file(prefix, begin, end, owner, s, tier, rate, out)
    size = np.maximum(end - begin - s.length + 1, 0)
    start = ranges(begin, size)
    if len(start):
        whole = stretch(prefix, start, start + s.length)
        zero = np.zeros(len(start), np.int64)
        out.append((mix(whole + _U(99)), whole, np.repeat(owner, size), start, zero, zero))
    if not out:
        none = np.empty(0, np.int64)
        return Rows(none.astype(_U), none.astype(_U), none, none, none, none)
    return Rows(*(np.concatenate(c) for c in zip(*out)))


def _file(prefix, begin, end, owner, s: Scheme, tier: int, rate: int, out: list) -> tuple:
    """File the windows between begin and end that hold an anchor; the stretches whose
    windows hold none come back."""
    spots = ranges(begin, np.maximum(end - begin - s.span + 1, 0))
    a = spots[stretch(prefix, spots, spots + s.span) % _U(rate) == 0]
    part = np.searchsorted(begin, a, "right") - 1
    before = np.maximum(np.concatenate([[-1], a[:-1]]), begin[part] - 1)
    lowest = np.maximum(0, a + s.length - end[part])
    highest = np.minimum(a - before - 1, s.length - s.span)
    bounds = (0, *s.cuts, s.length - s.span + 1)
    for kind, (first, stop) in enumerate(zip(bounds, bounds[1:])):
        low, high = np.maximum(lowest, first), np.minimum(highest, stop - 1)
        k = np.flatnonzero(low <= high)
        if not len(k):
            continue
        at, low, high = a[k], low[k], high[k]
        key = stretch(prefix, at - first, at + s.length - stop + 1)
        context = stretch(prefix, at - high, at - low + s.length)
        context = mix(context + high.astype(_U) * _K1 + low.astype(_U) * _K2)
        out.append((mix(key + _U(16 * tier + kind + 1)), context, owner[part[k]], at, low, high))
    # What lies between two anchors, up to the first symbol that a window with the later one needs.
    start = np.concatenate([begin, a + 1])
    of = np.concatenate([np.arange(len(begin)), part])
    place = np.searchsorted(a, start)
    after = np.append(a, np.int64(len(prefix) + s.length))[place]
    stop = np.minimum(after + s.span - 1, end[of])
    keep = stop - start >= s.length
    order = np.argsort(start[keep], kind="stable")
    return start[keep][order], stop[keep][order], owner[of[keep][order]]


def union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the stretches from start to end."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return start[first], reach[np.concatenate([first[1:] - 1, [len(start) - 1]])]
