"""Operator 13, periodic runs of words: branching-tandem test over an enhanced suffix array.

Texts of a batch are sorted together, each by itself: the first key of a suffix is its document. For every LCP
interval of depth d the suffixes of all children but the largest are looked at; where the suffix d words on (or
back) is in the interval, too, but in another child, two equal strings of d words stand side by side and the square
cannot be moved to the right. Every run has exactly one such square for its smallest period. Rotating it to the
left as far as it goes gives the run; squares of a multiple of the period end where the run ends and merge into it.
Intervals are pairs of places in the array; no tree is built. Everything but the last step on the few squares that
are left is done on whole arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardmill.llm.common import WORD_CLASS, free, ship

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
# Words sorted together; a longer text is sorted alone.
BATCH_WORDS = 1 << 17
# Words compared at once when a square is rotated.
STRIDE = 4096

WORD = re.compile(WORD_CLASS + "+")
ADDED = ("n_runs", "periodic_runs", "collapsed")
RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Order of the suffixes, the rank of each, and ranks by the first 1, 2, 4 ... symbols.

    No suffix may be a prefix of another one, which a closing symbol of its own in each text makes sure of. Only
    suffixes that still share their rank are sorted again.
    """
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(len(symbols), dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    levels, width = [rank.astype(np.int32)], 1
    open_ = order[~(new & np.append(new[1:], True))]
    while len(open_):
        key = rank[open_] * len(symbols) + rank[open_ + width]
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        at, group = np.arange(len(key)), key // len(symbols)
        first = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1])), at, 0))
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[open_] = group + np.maximum.accumulate(np.where(new, at, 0)) - first
        open_ = open_[~(new & np.append(new[1:], True))]
        width *= 2
        levels.append(rank.astype(np.int32))
    order = np.empty(len(rank), dtype=np.int64)
    order[rank] = np.arange(len(rank))
    return order, rank, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in the order."""
    a, b = order[:-1], order[1:]
    pairs = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b, length = a[pairs], b[pairs], np.zeros(len(pairs), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        names = levels[level]
        # A prefix that matched ends before the closing symbol of its text.
        length += (names[a + length] == names[b + length]).astype(np.int64) << level
    out = np.zeros(len(order), dtype=np.int64)
    out[pairs + 1] = length
    return out


def _nearest_smaller(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest place before and behind it with a smaller value (0 and the length are taken as such).

    Halving steps over minima of 1, 2, 4 ... values in a row.
    """
    n, minima = len(values), [values]
    while 2 ** len(minima) <= n:
        last, half = minima[-1], 2 ** (len(minima) - 1)
        minima.append(np.minimum(last[:-half], last[half:]))
    here = values[places]
    before, behind = places.copy(), places + 1
    for level in range(len(minima) - 1, -1, -1):
        low, step = minima[level], 2**level
        fits = before - step >= 0
        fits &= low[np.where(fits, before - step, 0)] >= here
        before -= fits * step
        fits = behind + step <= n
        fits &= low[np.where(fits, behind, 0)] >= here
        behind += fits * step
    return before - 1, behind


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [first, last) and the range of each."""
    sizes = last - first
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[of], of


def branching_squares(
    order: np.ndarray, rank: np.ndarray, lcp: np.ndarray, most: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of the squares that cannot be moved to the right.

    ``most`` is the largest period of interest at each suffix; deeper intervals are left out.
    """
    places = np.flatnonzero((lcp > 0) & (lcp <= most[order]))
    low, high = _nearest_smaller(lcp, places)
    depth = lcp[places]
    by = np.lexsort((places, high, low))
    places, low, high, depth = places[by], low[by], high[by], depth[by]
    new = np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])))[: len(places)]
    first = np.flatnonzero(new)
    if not len(first):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    # Children of an interval: before its first place, and from each place to the next.
    interval = np.cumsum(new) - 1
    following = np.append(places[1:], 0)
    following[np.append(first[1:] - 1, len(places) - 1)] = high[first]
    begins = np.concatenate((low[first], places))
    ends = np.concatenate((places[first], following))
    of = np.concatenate((np.arange(len(first)), interval))
    by = np.lexsort((ends - begins, of))
    largest = by[np.append(np.flatnonzero(np.diff(of[by])), len(by) - 1)]
    small = np.ones(len(of), dtype=bool)
    small[largest] = False
    begins, ends, of = begins[small], ends[small], of[small]
    slots, child = _spread(begins, ends)
    begins, ends, of = begins[child], ends[child], of[child]
    low, high, depth = low[first][of], high[first][of], depth[first][of]
    starts, periods = [], []
    for sign in (1, -1):
        other = order[slots] + sign * depth
        inside = (other >= 0) & (other < len(order))
        slot = rank[np.where(inside, other, 0)]
        inside &= (slot >= low) & (slot < high) & ((slot < begins) | (slot >= ends))
        starts.append(np.minimum(order[slots], other)[inside])
        periods.append(depth[inside])
    pairs = np.unique(np.stack((np.concatenate(starts), np.concatenate(periods))), axis=1)
    return pairs[0], pairs[1]


def _rotate(symbols: np.ndarray, start: int, period: int, floor: int) -> int:
    """The first place from which on everything up to ``start`` repeats with the period."""
    while start > floor:
        low = max(floor, start - STRIDE)
        differ = np.flatnonzero(symbols[low:start] != symbols[low + period : start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start = low
    return start


def periodic_runs(
    texts: list[np.ndarray], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> list[list[tuple[int, int, int]]]:
    """Start, length and smallest period of the runs of every text, given as arrays of symbols >= 0.

    A run has at least ``least_length`` symbols and ``least_exponent`` periods (2 or more).
    """
    if least_exponent < 2:
        raise ValueError("a run has two periods at least")
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    firsts = np.cumsum(sizes + 1) - sizes - 1
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    closing = np.array([-1], dtype=np.int64)
    symbols = np.concatenate([part for t in texts for part in (t, closing)])
    # A symbol of one text is none of another; the closing one comes first.
    keys = text_of * (int(symbols.max()) + 2) + symbols + 1
    order, rank, levels = suffix_array(keys)
    lcp = common_prefixes(order, levels)
    del levels
    starts, periods = branching_squares(order, rank, lcp, (sizes // least_exponent)[text_of])
    floors = firsts[text_of[starts]]
    need = np.maximum(least_length, least_exponent * periods) - 2 * periods
    # The place that a long enough run reaches, and the one before the square.
    fits = starts - need >= floors
    for back in (np.minimum(need, 1), need):
        place = np.where(fits, starts - back, 0)
        fits &= symbols[place] == symbols[place + periods]
    starts, periods, floors = starts[fits], periods[fits], floors[fits]
    ends = starts + 2 * periods
    last_end, reach = -1, 0
    for i in np.lexsort((periods, ends)):
        start, period, end, floor = int(starts[i]), int(periods[i]), int(ends[i]), int(floors[i])
        if end != last_end:
            last_end, reach = end, 0
        if 2 * period <= reach:
            continue  # a multiple of the period of the run found there
        begin = _rotate(symbols, start, period, floor)
        if end - begin >= max(least_length, least_exponent * period):
            reach = max(reach, end - begin)
            out[int(text_of[start])].append((begin - floor, end - begin, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that are in no run behind its first period, joined by one space."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change)[:-1] == 0
    return " ".join(w for w, k in zip(words, kept, strict=True) if k)


def _of_texts(texts: Iterable[str | None]) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    """Runs and collapsed text of each text in order, so many words at a time."""
    names: dict[str, int] = {}
    words, coded, total = [], [], 0

    def flush():
        for w, runs in zip(words, periodic_runs(coded), strict=True):
            yield runs, collapse(w, runs)

    for text in texts:
        found = WORD.findall(text or "")
        if words and total + len(found) > BATCH_WORDS:
            yield from flush()
            names, words, coded, total = {}, [], [], 0
        words.append(found)
        coded.append(np.array([names.setdefault(w, len(names)) for w in found], dtype=np.int64))
        total += len(found)
    yield from flush()


def _annotate(text_col: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = list(_of_texts(x.as_py() for x in batch.column(text_col)))
            runs = [[{"start": s, "length": n, "period": p} for s, n, p in found] for found, _ in done]
            columns = [batch.column(name) for name in batch.schema.names]
            columns += [pa.array([len(r) for r in runs], pa.int64()), pa.array(runs, _RUNS), pa.array([t for _, t in done], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *ADDED])

    return run


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the runs of repeated words of each text.

    Adds ``n_runs``, ``periodic_runs`` (start and length in words, smallest period, ordered by start and period) and
    ``collapsed``: the words that no run contains behind its first period, joined by one space. Input columns of
    these names are replaced.

    * A run has at least 6 words and four periods, and no neighbouring word extends it.
    * Null, empty and blank texts have no runs and the empty text as ``collapsed``.
    * Rows are judged one by one, so nulls elsewhere, repeated rows, an empty table and other columns do not matter.
    * A task holds some 400 bytes for each word of a batch of texts (2 ** 17 words), or of the longest text if that has more.
    """
    ship(docs.sparkSession)
    docs = free(docs, *ADDED)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    added = f"n_runs bigint, periodic_runs array<{RUN}>, collapsed string"
    return docs.mapInArrow(_annotate(text_col), f"{fields}, {added}")


def strongest_run(runs: str):
    """Of the runs in a column the one with the greatest length/period, then the smallest start, then period; or null."""

    def better(best, run):
        left, right = run["length"] * best["period"], best["length"] * run["period"]
        first = (run["start"] < best["start"]) | ((run["start"] == best["start"]) & (run["period"] < best["period"]))
        return F.when(best.isNull() | (left > right) | ((left == right) & first), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)
