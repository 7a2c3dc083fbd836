"""Runs of words that repeat with a period, found by multi-scale minimizers and by direct scans of short lags."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhawk.llm.common import byte_balanced, fresh_name, slices, text_column
from tallyhawk.llm.word_hashes import WORD_BASE, mixed, powers

#: Words of the shortest run, and periods that a run holds at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Periods up to this are found by comparing words so far apart; longer ones by minimizers.
LAGS = 8
#: Bytes of texts whose words one step holds as arrays.
STEP_BYTES = 1 << 20

RESULT = {
    "n_runs": T.LongType(),
    "start": T.LongType(),
    "length": T.LongType(),
    "period": T.LongType(),
    "exponent_milli": T.LongType(),
    "runs_sha256": T.StringType(),
    "collapsed_sha256": T.StringType(),
}

#: Words of a document before the search, from its id and the words of its text.
Rewrite = Callable[[object, list[bytes]], list[bytes]]


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, collapsed) for each row of `df`.

    A run is a stretch of words with smallest period q, max(6, 4 q) words long at least, that can't be extended to
    either side. The columns start to exponent_milli (1000 times length by period) tell of the longest, the first
    of equal ones, with the smallest period; they are null without a run. `collapsed` are the words without those
    that some run contains after its first period. A null or empty text has no words and no run. Repeated rows give
    repeated results, an empty table an empty one; other columns are not read. `rewrite` may change the words of a
    document first. Texts of any length are searched whole; a step holds about STEP_BYTES of texts, or one text.
    """
    names = [fresh_name([id_col], x) for x in (*RESULT, "collapsed")]
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), *(T.StructField(n, t) for n, t in zip(names, (*RESULT.values(), T.StringType()), strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            idents, texts = batch.column(id_col), text_column(batch, text_col)
            for first, last in byte_balanced(texts, STEP_BYTES):
                docs = [x.encode().split() for x in texts[first:last]]
                if rewrite is not None:
                    docs = [rewrite(i, words) for i, words in zip(idents[first:last].to_pylist(), docs, strict=True)]
                found = find_runs(docs)
                rows = [_digest(words, runs) for words, runs in zip(docs, found, strict=True)]
                columns = [pa.array(column, _ARROW[k]) for k, column in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([idents[first:last], *columns], schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


_ARROW = [*([pa.int64()] * 5), *([pa.string()] * 3)]


def _digest(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    lines = b"".join(b"%d,%d,%d\n" % x for x in runs)
    kept = words
    best: tuple = (None, None, None, None)
    if runs:
        start, length, period = min(runs, key=lambda x: (-x[1], x[0], x[2]))
        best = (start, length, period, 1000 * length // period)
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
    text = b" ".join(kept)
    return (len(runs), *best, hashlib.sha256(lines).hexdigest(), hashlib.sha256(text).hexdigest(), text.decode())


def find_runs(docs: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each document, by start, then period."""
    number = defaultdict(count().__next__)
    lengths = np.array([len(x) for x in docs], np.int64)
    parts, gap = [], -1
    for words in docs:
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        # What lies between two documents equals nothing.
        parts.append(np.array([gap]))
        gap -= 1
    codes = np.concatenate(parts) if parts else np.empty(0, np.int64)
    offsets = np.cumsum(np.append(0, lengths + 1))
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, LAGS + 1):
        for start, end in _stretches(codes, lag):
            _add(found, start, end, lag)
    least, longest = LAGS + 1, int(lengths.max(initial=0)) // LEAST_PERIODS
    while least <= longest:
        scale = _scale(least)
        own = np.flatnonzero(lengths >= LEAST_PERIODS * least)
        places = np.concatenate([np.arange(offsets[d], offsets[d + 1]) for d in own.tolist()])
        for start, end, period in _runs_of_scale(codes[places], scale):
            _add(found, int(places[start]), int(places[start]) + end - start, period)
        least = scale + 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    for (start, end), period in found.items():
        d = int(np.searchsorted(offsets, start, "right")) - 1
        runs[d].append((start - int(offsets[d]), end - start, period))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in runs]


def _add(found: dict[tuple[int, int], int], start: int, end: int, period: int) -> None:
    """Keep a stretch that is long enough, with its smallest period: a multiple has the same bounds."""
    if end - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
        found[start, end] = min(period, found.get((start, end), period))


def _stretches(codes: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """Bounds of the longest stretches in which words `lag` apart are equal, long ones only."""
    least = max(LEAST_WORDS, LEAST_PERIODS * lag) - lag
    equal = np.flatnonzero(codes[lag:] == codes[:-lag])
    if len(equal) < least:
        return
    breaks = np.flatnonzero(np.diff(equal) != 1)
    firsts, lasts = np.append(0, breaks + 1), np.append(breaks, len(equal) - 1)
    long = lasts - firsts + 1 >= least
    for first, last in zip(equal[firsts[long]].tolist(), equal[lasts[long]].tolist(), strict=True):
        yield first, last + lag + 1


def _scale(least: int) -> int:
    """The largest window for periods from `least`.

    A run of period q holds 4 q words. Its sequences of s >= q words are the same again after q words and differ
    within a period, so that a window over s of them has one minimum, and windows that begin behind it have the
    next one q words on. Both windows lie inside the run if they begin within q words and q + 2 s - 1 <= 4 q.
    """
    return (3 * least + 1) // 2


def _runs_of_scale(codes: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """Stretches (start, end, period) with periods of LAGS to `scale` words that equal minimizers point to."""
    n = len(codes) - scale + 1
    up, down = powers(WORD_BASE, len(codes) + 1)
    prefix = np.append(np.uint64(0), np.cumsum(mixed(codes.astype(np.uint64)) * up[:-1], dtype=np.uint64))
    hashes = mixed((prefix[scale:] - prefix[:-scale]) * down[:n])
    selected = _minimizers(hashes, scale)
    order = selected[np.argsort(hashes[selected], kind="stable")]
    near = np.diff(order)
    same = (hashes[order[1:]] == hashes[order[:-1]]) & (near <= scale) & (near > LAGS)
    ends: dict[int, int] = {}
    seeds = sorted(zip(order[:-1][same].tolist(), near[same].tolist(), strict=True))
    for place, period in seeds:
        # Seeds come by place: those inside a stretch that is known for their period say nothing new.
        if place + period < ends.get(period, 0):
            continue
        start, end = _extended(codes, place, period)
        ends[period] = end
        yield start, end, period


def _minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the first lowest hash of each window, rising."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    bits = np.uint64(len(hashes).bit_length())
    # High bits of the hash, then the place: the least of these is the first lowest.
    keys = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    blocks = -(-len(keys) // window)
    padded = np.full(blocks * window, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(behind[:n], ahead[window - 1 : window - 1 + n])
    places = (lowest & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return places[np.append(True, np.diff(places) != 0)]


def _extended(codes: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """The bounds of the stretch of this period around `place`, word by word; `place` and the word a period on are equal or it is empty."""
    end = _first_difference(codes, place, period, 1)
    start = _first_difference(codes, place - 1, period, -1) + 1
    return (start, end + period) if end > start else (place, place)


def _first_difference(codes: np.ndarray, place: int, period: int, step: int) -> int:
    """The first word from `place` on, or back, that differs from the one a period later; or where there is none."""
    size = 64
    last = len(codes) - period
    while 0 <= place < last:
        if step > 0:
            stop = min(place + size, last)
            differ = np.flatnonzero(codes[place:stop] != codes[place + period : stop + period])
            if len(differ):
                return place + int(differ[0])
            place = stop
        else:
            stop = max(place - size + 1, 0)
            differ = np.flatnonzero(codes[stop : place + 1] != codes[stop + period : place + period + 1])
            if len(differ):
                return stop + int(differ[-1])
            place = stop - 1
        size *= 2
    return place
