"""Jaro-Winkler similarity: the one measure Spark has no expression for.

Evaluated per Arrow batch with numpy over padded byte matrices of texts of like length;
a long pair is walked once through the positions of each byte, so a row costs what its own
length asks for.  Bytes, not characters, are compared.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

# fixed values: prefix weight, longest prefix counted, smallest Jaro that is boosted
PREFIX_WEIGHT, PREFIX_CAP, BOOST_FLOOR = 0.1, 4, 0.7
_ROWS_PER_BLOCK = 4096
_LONG = 256


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    width = max(int(lengths.max(initial=0)), PREFIX_CAP)
    flat = b"".join(t.ljust(width, b"\0") for t in texts)
    return np.frombuffer(flat, dtype=np.uint8).reshape(len(texts), width), lengths


def _block_similarity(left: list[bytes], right: list[bytes]) -> np.ndarray:
    a, la = _padded(left)
    b, lb = _padded(right)
    rows = np.arange(len(left))
    cols = np.arange(b.shape[1])
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    hit_a = np.zeros(a.shape, dtype=bool)
    free_b = cols[None, :] < lb[:, None]
    for i in range(int(la.max(initial=0))):
        near = (cols >= i - reach) & (cols <= i + reach)
        candidates = (b == a[:, i : i + 1]) & free_b & near & (i < la)[:, None]
        found = candidates.any(axis=1)
        first = candidates.argmax(axis=1)
        free_b[rows[found], first[found]] = False
        hit_a[:, i] = found
    hit_b = ~free_b & (cols[None, :] < lb[:, None])
    matched = hit_a.sum(axis=1)

    # matched bytes moved to the front, in order, then compared place by place
    seq_a = np.take_along_axis(a, np.argsort(~hit_a, axis=1, kind="stable"), axis=1)
    seq_b = np.take_along_axis(b, np.argsort(~hit_b, axis=1, kind="stable"), axis=1)
    width = min(a.shape[1], b.shape[1])
    place = np.arange(width)[None, :] < matched[:, None]
    swaps = ((seq_a[:, :width] != seq_b[:, :width]) & place).sum(axis=1) // 2

    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (matched / la + matched / lb + (matched - swaps) / matched) / 3
    jaro = np.where(matched > 0, jaro, 0.0)
    same = (a[:, :PREFIX_CAP] == b[:, :PREFIX_CAP]) & (
        np.arange(PREFIX_CAP)[None, :] < np.minimum(la, lb)[:, None]
    )
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > BOOST_FLOOR, jaro + PREFIX_WEIGHT * prefix * (1 - jaro), jaro)


def _long_similarity(a: bytes, b: bytes) -> float:
    """One pair of any length, in time proportional to it.

    The window over ``b`` only moves forward, so the first free place of a byte is always the
    next one of its list that the window has not passed.
    """
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    codes = np.frombuffer(b, dtype=np.uint8)
    places = {c: np.flatnonzero(codes == c).tolist() for c in set(b)}
    turn = dict.fromkeys(places, 0)
    taken, matched = [], bytearray()
    for i, c in enumerate(a):
        if c not in places:
            continue
        own, k = places[c], turn[c]
        while k < len(own) and own[k] < i - reach:
            k += 1
        if k < len(own) and own[k] <= i + reach:
            taken.append(own[k])
            matched.append(c)
            k += 1
        turn[c] = k
    m = len(matched)
    if not m:
        return 0.0
    other = codes[np.sort(taken)]
    swaps = int((np.frombuffer(matched, dtype=np.uint8) != other).sum()) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(PREFIX_CAP, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + PREFIX_WEIGHT * prefix * (1 - jaro) if jaro > BOOST_FLOOR else jaro


def _similarities(a: list[bytes], b: list[bytes]) -> np.ndarray:
    size = np.fromiter((max(len(x), len(y)) for x, y in zip(a, b)), dtype=np.int64, count=len(a))
    order = np.argsort(size, kind="stable")
    short = int(np.searchsorted(size[order], _LONG, "right"))
    out = np.zeros(len(a))
    for start in range(0, short, _ROWS_PER_BLOCK):
        rows = order[start : min(start + _ROWS_PER_BLOCK, short)]
        out[rows] = _block_similarity([a[i] for i in rows], [b[i] for i in rows])
    for i in order[short:]:
        out[i] = _long_similarity(a[i], b[i])
    return out


def similarity_of(left: pd.Series, right: pd.Series) -> pd.Series:
    known = (left.notna() & right.notna()).to_numpy()
    out = np.full(len(left), np.nan)
    a = [t.encode("utf-8") for t in left[known]]
    b = [t.encode("utf-8") for t in right[known]]
    out[known] = _similarities(a, b)
    return pd.Series(out).where(pd.Series(known), None)


def jaro_winkler(left: Column, right: Column) -> Column:
    """Declared non-deterministic so that a filter on the result is not pushed below it,
    which would evaluate it once for the filter and once more for the value."""
    udf = F.pandas_udf(similarity_of, DoubleType()).asNondeterministic()
    return udf(left, right)


def can_reach(left: Column, right: Column, threshold: float) -> Column:
    """Cheap JVM-side necessary condition for ``jaro_winkler >= threshold``.

    With the longest prefix boost the Jaro part must reach j = (t - 0.4) / 0.6, and
    Jaro is at most (m/|a| + m/|b| + 1) / 3 for m matched bytes.  m is at most the
    shorter length and, for one-byte text, the number of bytes that occur in the
    other side at all.  Pairs failing the bound cannot pass, so none are lost.
    """
    boost = PREFIX_WEIGHT * PREFIX_CAP
    needed = 3 * (threshold - boost) / (1 - boost) - 1 - 1e-9
    size_a, size_b = F.octet_length(left), F.octet_length(right)
    one_byte = (size_a == F.length(left)) & (size_b == F.length(right))
    absent_a = F.length(F.call_function("translate", left, right, F.lit("")))
    absent_b = F.length(F.call_function("translate", right, left, F.lit("")))
    by_length = F.least(size_a, size_b)
    most = F.when(
        one_byte, F.least(size_a - absent_a, size_b - absent_b)
    ).otherwise(by_length)

    def enough(m: Column) -> Column:
        return F.coalesce(F.try_divide(m, size_a) + F.try_divide(m, size_b), F.lit(0.0)) >= needed

    return enough(by_length) & enough(most)


def least_jaro(threshold: float, prefix: int) -> float:
    """Smallest Jaro similarity that reaches ``threshold`` with ``prefix`` equal first bytes."""
    boost = PREFIX_WEIGHT * prefix
    return (threshold - boost) / (1 - boost)


# Order in which letters are dealt out to groups, so that each group holds frequent ones.
_DEALT = {c: i for i, c in enumerate(b"eaoinrslthcdumygkbpfvwjzxq ")}
_RANK = np.array([_DEALT.get(c, c) for c in range(256)])
_U64 = np.uint64
_LETTER = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U64) * _U64(2) + _U64(1)
#: pairs with a long equal beginning need ``NEAR_PREFIX`` bytes of it, the others have less
NEAR_PREFIX = 3
#: letters that may differ beyond which a pair is kept apart by lengths and beginning alone
MOST_APART = 10


@cache
def length_band(n: int) -> int:
    """Lengths up to 32 each by themselves, then bands of about an eighth."""
    return n if n <= 32 else 32 + int(8 * math.log2(n / 32)) + 1


@cache
def band_lengths(band: int) -> tuple[int, int]:
    """Smallest and largest length of a band."""
    if band <= 32:
        return band, band
    low = max(33, math.floor(32 * 2 ** ((band - 33) / 8)) - 1)
    while length_band(low) < band:
        low += 1
    high = low
    while length_band(high + 1) == band:
        high += 1
    return low, high


@cache
def apart(a: int, b: int, needed: float) -> int | None:
    """Most letters by which names of the bands ``a`` and ``b`` may differ; None if none can pass.

    m matched bytes of |x| and |y| must reach m/|x| + m/|y| >= ``needed``, and m is at most the
    number of letters that the names share, so they differ in |x| + |y| - 2m letters at most.
    """
    most = None
    for x in range(band_lengths(a)[0], band_lengths(a)[1] + 1):
        for y in range(band_lengths(b)[0], band_lengths(b)[1] + 1):
            m = max(0, math.ceil(needed * x * y / (x + y) - 1e-9))
            if m <= min(x, y):
                most = max(most or 0, x + y - 2 * m)
    return most


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(31))) * _U64(0x7FB5D329728EA185)
    x = (x ^ (x >> _U64(27))) * _U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U64(33))


def _of_one_band(names: list[bytes], own: int, threshold: float, first: bool) -> np.ndarray:
    """Signatures (names x any) of names whose lengths share a band; see ``signatures_of``."""
    letters, lengths = _padded(names)
    inside = np.arange(letters.shape[1])[None, :] < lengths[:, None]
    value, rank = np.where(inside, _LETTER[letters], _U64(0)), _RANK[letters]
    grouped: dict[int, np.ndarray] = {}
    out = []
    for kind, prefix in ((1, NEAR_PREFIX), (2, 0)):
        shared = PREFIX_CAP if prefix else NEAR_PREFIX - 1
        needed = 3 * least_jaro(threshold, shared) - 1 - 1e-9
        begin = np.full(len(names), kind, _U64)
        for j in range(prefix):
            begin = _mixed(begin + _LETTER[letters[:, j]] * inside[:, j].astype(_U64))
        widest = length_band(math.ceil(band_lengths(own)[1] / max(needed - 1, 0.05)))
        for other in range(1, widest + 1):
            pair = (own, other) if first else (other, own)
            most = apart(*pair, needed)
            if most is None:
                continue
            key = _mixed(begin + _U64((kind << 40) + (pair[0] << 20) + pair[1]))
            if most > MOST_APART:
                out.append(key)
                continue
            groups = most + 2
            if groups not in grouped:
                of = rank % groups
                grouped[groups] = np.stack([(value * (of == g)).sum(axis=1) for g in range(groups)], axis=1)
            sums = grouped[groups]
            for g in range(groups):
                for h in range(g + 1, groups):
                    out.append(_mixed(_mixed(key + sums[:, g] + _U64(g * 64 + h)) + sums[:, h]))
    return np.stack(out, axis=1) if out else np.zeros((len(names), 0), _U64)


def signatures_of(names: pd.Series, threshold: float, first: bool) -> pd.Series:
    """Per name signatures such that two names that reach ``threshold`` share one.

    Two names with k bytes of common beginning need a Jaro similarity of ``least_jaro(k)``, and so
    share all but a few of their letters (``apart``, d of them).  The alphabet is dealt to d + 2
    groups; d differing letters leave at least two groups untouched, and a signature stands for
    the letters of two groups, the two lengths, and the beginning where at least three bytes of it
    are equal.  ``first`` says which of the two lengths is the name's own.
    """
    out = pd.Series([[] for _ in range(len(names))], index=names.index, dtype=object)
    texts = [t.encode("utf-8") if isinstance(t, str) else b"" for t in names]
    bands: dict[int, list[int]] = {}
    for i, t in enumerate(texts):
        if t:
            bands.setdefault(length_band(len(t)), []).append(i)
    for band, rows in bands.items():
        for start in range(0, len(rows), _ROWS_PER_BLOCK):
            some = rows[start : start + _ROWS_PER_BLOCK]
            for i, sig in zip(some, _of_one_band([texts[i] for i in some], band, threshold, first).view(np.int64)):
                out.iat[i] = sig
    return out


def name_signatures(name: Column, threshold: float, first: bool) -> Column:
    udf = F.pandas_udf(lambda names: signatures_of(names, threshold, first), ArrayType(LongType()))
    return udf.asNondeterministic()(name)
