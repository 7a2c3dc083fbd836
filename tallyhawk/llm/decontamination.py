"""Benchmark decontamination: pairs of near words find passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyhawk.llm.common import byte_balanced, fresh_name, release_memory, slices, text_column
from tallyhawk.llm.word_hashes import WORD_BASE, Words, hash_words, mixed

#: Items of fewer words are looked for as a whole, others by pairs of words that are one or two places apart.
SEED_WORDS = 5
#: The number by which these pairs stand where whole items stand by their length.
PAIRS = 0
GAPS = (1, 2)
#: Share of the best possible alignment score from which a text holds an item.
LEAST_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of benchmark text that are searched for at a time; bounds what is broadcast. More items take more passes.
BLOCK_BYTES = 8 << 20
HASH_BYTES = 1 << 19
FILTER_BITS = 22

#: Words are runs of ASCII letters and digits and of all other characters beyond ASCII, in lower case.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain(text: str) -> bytes:
    return text.lower().encode().translate(_TABLE)


def pair_hashes(words: Words, start: np.ndarray, gap: int) -> np.ndarray:
    """Hashes of the words at `start` and `gap` places later; a pair has one hash, however far apart its words stand."""
    return mixed(words.hashes[start] * np.uint64(WORD_BASE) + words.hashes[start + gap])


def near_pairs(n: int, least: float) -> int:
    """How many near pairs any alignment of an item of n words has that scores `least`.

    A pair of neighbouring matches is near if at most one word stands between them, in the item and in the passage.
    One that is not costs 2 at least. M matches score 2 M - 2 f at most with f such pairs; from a score of 2 n least on,
    f is M - n least at most, and of M - 1 pairs n least - 1 are near. Each begins at a word of its own on either side.
    """
    return ceil(n * least - 1 - 1e-9)


def longest_passage(n: int, least: float) -> int:
    """Most words of a passage that aligns so well: L words of which M match score 3 M - L at most."""
    return int(3 * n - MATCH * n * least + 1e-9)


@dataclass
class Block:
    """Some benchmark items, and the seeds by which they are found: near pairs of words, short items as a whole."""

    ids: list[Any]
    words: list[list[bytes]]
    #: How many seeds a passage must have to be aligned with an item.
    needed: np.ndarray
    #: By kind of seed: sorted hashes, and for each the (item, place) pairs from `bounds[i]` to `bounds[i + 1]`.
    hashes: dict[int, np.ndarray]
    bounds: dict[int, np.ndarray]
    items: dict[int, np.ndarray]
    places: dict[int, np.ndarray]

    @classmethod
    def of(cls, ids: list[Any], texts: list[str]) -> Block:
        words = [plain(x).split() for x in texts]
        found = hash_words([b" ".join(x) for x in words])
        grams: dict[int, list[tuple[int, int, int]]] = {}
        for item, own in enumerate(words):
            first, n = found.offsets[item], len(own)
            if n >= SEED_WORDS:
                for gap in GAPS:
                    pairs = pair_hashes(found, first + np.arange(n - gap), gap)
                    grams.setdefault(PAIRS, []).extend((int(h), item, place) for place, h in enumerate(pairs))
            elif n:
                whole = found.spans(np.array([first]), np.array([first + n]))
                grams.setdefault(n, []).append((int(whole[0]), item, 0))
        block = cls(ids, words, np.ones(len(words), np.int64), {}, {}, {}, {})
        for n, rows in grams.items():
            block._set(n, np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        return block

    def _set(self, n: int, hashes: np.ndarray, items: np.ndarray, places: np.ndarray) -> None:
        order = np.lexsort((places, items, hashes))
        hashes, self.items[n], self.places[n] = hashes[order], items[order], places[order]
        self.hashes[n], first = np.unique(hashes, return_index=True)
        self.bounds[n] = np.append(first, len(hashes))

    def rare(self, frequency: np.ndarray, least: float) -> Block:
        """The block without the most frequent pairs of each item, as many as no alignment that scores `least` depends on.

        Such an alignment has near_pairs at so many places of the item. Of these half may be left out, whichever they are:
        the other half is still `needed` in a passage. Frequencies decide what a search costs, not what it finds.
        """
        block = Block(self.ids, self.words, np.ones(len(self.words), np.int64), dict(self.hashes), dict(self.bounds), dict(self.items), dict(self.places))
        if PAIRS not in self.hashes:
            return block
        of_pair = np.repeat(np.arange(len(frequency)), np.diff(self.bounds[PAIRS]))
        rows = pd.DataFrame({"item": self.items[PAIRS], "place": self.places[PAIRS], "n": frequency[of_pair]})
        places = rows.groupby(["item", "place"], as_index=False)["n"].sum().sort_values(["item", "n", "place"], ascending=[True, False, True])
        near = np.array([near_pairs(len(x), least) if len(x) >= SEED_WORDS else 1 for x in self.words])
        block.needed = (near + 1) // 2
        places["kept"] = places.groupby("item").cumcount().to_numpy() >= (near - block.needed)[places["item"]]
        keep = rows.merge(places[["item", "place", "kept"]], on=["item", "place"], how="left")["kept"].to_numpy()
        block._set(PAIRS, self.hashes[PAIRS][of_pair][keep], self.items[PAIRS][keep], self.places[PAIRS][keep])
        return block


class Finder:
    """Looks up the n-grams of texts among those of a block."""

    def __init__(self, block: Block):
        self.block = block
        self.filters = {}
        for n, hashes in block.hashes.items():
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.filters[n] = bits

    def hits(self, words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, gram) of each seed of a kind that is in the texts."""
        if n != PAIRS:
            return self._known(words, n, n, lambda start: words.spans(start, start + n))
        found = [self._known(words, n, gap + 1, lambda start, gap=gap: pair_hashes(words, start, gap)) for gap in GAPS]
        text, place, gram = (np.concatenate(x) for x in zip(*found, strict=True))
        return text, place, gram

    def _known(
        self, words: Words, n: int, width: int, hashed: Callable[[np.ndarray], np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = np.empty(0, np.int64)
        size = len(words.hashes) - width + 1
        if size <= 0:
            return none, none, none
        start = np.arange(size)
        grams = hashed(start)
        start = np.flatnonzero(self.filters[n][(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        grams, hashes = grams[start], self.block.hashes[n]
        gram = np.minimum(np.searchsorted(hashes, grams), len(hashes) - 1)
        text = np.searchsorted(words.offsets, start, side="right") - 1
        sound = (hashes[gram] == grams) & (start + width <= words.offsets[text + 1])
        start, text = start[sound], text[sound]
        return text, start - words.offsets[text], gram[sound]


def align(item: list[int], passage: list[int]) -> tuple[int, int, int]:
    """The best local alignment of two word sequences: score, and the first and last + 1 place in the passage.

    Smith-Waterman with linear gaps. A row is computed at once: a gap along it is a running maximum.
    """
    m = len(passage)
    text = np.array(passage)
    slope = np.arange(m + 1) * -GAP
    row, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        up = row[1:] + GAP
        cell = np.maximum(np.maximum(diagonal, up), 0)
        begin = np.where(cell == 0, np.arange(1, m + 1), np.where(cell == diagonal, origin[:-1], origin[1:]))
        cell, begin = np.append(0, cell), np.append(0, begin)
        lifted = cell + slope
        along = np.maximum.accumulate(lifted)
        # Where a gap wins, the alignment began where the cell did that the gap starts from.
        source = np.maximum.accumulate(np.where(lifted == along, np.arange(m + 1), 0))
        row, origin = along - slope, begin[source]
        end = int(row.argmax())
        if row[end] > best[0]:
            best = (int(row[end]), int(origin[end]), end)
    return best


class Scorer:
    """Finds the items of a block in texts."""

    def __init__(self, block: Block, least: float):
        self.block, self.least, self.finder = block, least, Finder(block)
        self.codes = [{w: i for i, w in enumerate(dict.fromkeys(x))} for x in block.words]
        self.coded = [[c[w] for w in x] for c, x in zip(self.codes, block.words, strict=True)]
        self.reach = np.array([longest_passage(len(x), least) if len(x) >= SEED_WORDS else len(x) for x in block.words], np.int64)

    def matches(self, texts: list[str]) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, score, first word, last word + 1) of each text and item that align well enough, the best place of each."""
        plains = [plain(x) for x in texts]
        for low, high in byte_balanced(plains, HASH_BYTES):
            t, item, first, last, shift = self._seeded(hash_words(plains[low:high]))
            ends = np.flatnonzero(np.append((t[1:] != t[:-1]) | (item[1:] != item[:-1]), True)) + 1 if len(t) else []
            split: tuple[int, list[bytes]] = (-1, [])
            start = 0
            for end in ends:
                if split[0] != t[start]:
                    split = int(t[start]), plains[low + t[start]].split()
                spans = zip(first[start:end].tolist(), last[start:end].tolist(), shift[start:end].tolist(), strict=True)
                found = self._best(split[1], int(item[start]), list(spans))
                if found is not None:
                    yield low + int(t[start]), int(item[start]), *found
                start = end

    def _seeded(self, words: Words) -> tuple[np.ndarray, ...]:
        """(text, item, first seed, last seed, shift) of all runs of as many seeds as needed that a passage could hold."""
        block, parts = self.block, []
        for n in block.hashes:
            text, place, gram = self.finder.hits(words, n)
            count = block.bounds[n][gram + 1] - block.bounds[n][gram]
            at = np.repeat(block.bounds[n][gram] - np.cumsum(count) + count, count) + np.arange(count.sum())
            parts.append((np.repeat(text, count), block.items[n][at], np.repeat(place, count), block.places[n][at]))
        if not parts:
            return (np.empty(0, np.int64),) * 5
        text, item, place, own = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((place, item, text))
        text, item, place, own = text[order], item[order], place[order], own[order]
        # Several seeds that begin at one word count once.
        new = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1]))[: len(text)]
        text, item, place, own = text[new], item[new], place[new], own[new]
        last = np.arange(len(text)) + block.needed[item] - 1
        inside = np.minimum(last, len(text) - 1)
        sound = (last == inside) & (text[inside] == text) & (item[inside] == item)
        sound &= place[inside] - place < self.reach[item]
        return text[sound], item[sound], place[sound], place[inside][sound], (place - own)[sound]

    def _best(self, words: list[bytes], item: int, spans: list[tuple[int, int, int]]) -> tuple[float, int, int] | None:
        own, code, known = self.coded[item], self.codes[item], self.block.words[item]
        reach = int(self.reach[item])
        regions: list[list[int]] = []
        for first, last, shift in spans:
            # An unedited copy needs no alignment.
            if shift >= 0 and words[shift : shift + len(own)] == known:
                return 1.0, shift, shift + len(own)
            low, high = max(0, last + 1 - reach), min(len(words), first + reach)
            if regions and low <= regions[-1][1]:
                regions[-1][1] = max(high, regions[-1][1])
            else:
                regions.append([low, high])
        full = MATCH * len(own)
        best: tuple[float, int, int] | None = None
        for low, high in regions:
            passage = [code.get(w, -1) for w in words[low:high]]
            if self._bound(passage) < self.least * full:
                continue
            score, begin, end = align(own, passage)
            if score >= self.least * full and (best is None or score / full > best[0]):
                best = score / full, low + begin, low + end
        return best

    @staticmethod
    def _bound(passage: list[int]) -> int:
        """No alignment scores more: a word of the item adds MATCH, any other takes off MISMATCH or GAP at least."""
        total = np.cumsum(np.where(np.array(passage) >= 0, MATCH, max(MISMATCH, GAP)))
        return int((total - np.minimum(np.minimum.accumulate(np.append(0, total[:-1])), 0)).max()) if len(total) else 0


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """The items with words, in blocks of BLOCK_BYTES; one block at a time is on the driver."""
    ids: list[Any] = []
    texts: list[str] = []
    size = 0
    for ident, text in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        ids.append(ident)
        texts.append(text)
        size += len(text)
        if size >= BLOCK_BYTES:
            yield Block.of(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Block.of(ids, texts)


def pair_frequency(df: DataFrame, block: Block, text_col: str) -> np.ndarray:
    """In how many texts of `df` each pair of a block occurs. A task sends a row per pair at most."""
    shared = df.sparkSession.sparkContext.broadcast(block)
    size = len(block.hashes.get(PAIRS, ()))
    result = np.zeros(size, np.int64)
    if not size:
        return result

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        count = np.zeros(size, np.int64)
        for batch in slices(batches):
            plains = [plain(x) for x in text_column(batch, text_col)]
            for low, high in byte_balanced(plains, HASH_BYTES):
                text, _, gram = finder.hits(hash_words(plains[low:high]), PAIRS)
                count += np.bincount(np.unique(text * size + gram) % size, minlength=size)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used])], ["gram", "n"])

    counted = df.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    result[counted["gram"].to_numpy()] = counted["n"].to_numpy()
    return result


def benchmark_matches(
    df: DataFrame,
    benchmark: DataFrame,
    least: float = LEAST_SCORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item, score, first_word, end_word): which texts of `df` hold which benchmark items, edited ones included.

    An item is looked for by its pairs of words that stand one or two places apart, the most frequent of them over all of `df`
    left out; so many must meet in a passage as every alignment that scores `least` has (see near_pairs), so none is missed.
    `least` is above 1 / SEED_WORDS. Items of fewer than SEED_WORDS words are looked for by all their words, unedited. Around
    such seeds the item is aligned with the text; `score` is the alignment's share of the best
    score, 1 for a copy, and rows from `least` on are returned, the best place per text and item. Words are
    compared in lower case without ASCII punctuation.

    Null or wordless texts and items match nothing. Repeated rows and items give repeated results, null ids stay null, an empty
    table on either side gives an empty result; other columns are not read. The benchmark is the query set: its items pass in
    blocks of BLOCK_BYTES, each of which is broadcast and takes two scans of `df`; nothing of `df` is shuffled but counts.
    """
    id_type, item_type = df.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField(item_col, item_type),
            T.StructField("score", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("end_word", T.LongType()),
        ]
    )
    items_type = to_arrow_type(item_type)
    parts = [df.sparkSession.createDataFrame([], schema)]
    for block in _blocks(benchmark, item_col, item_text_col):
        shared = df.sparkSession.sparkContext.broadcast(block.rare(pair_frequency(df, block, text_col), least))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(shared.value, least)
            for batch in slices(batches):
                rows = list(scorer.matches(text_column(batch, text_col)))
                text, item, score, first, end = zip(*rows, strict=True) if rows else ((), (), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(id_col).take(pa.array(text, pa.int64())),
                        pa.array([shared.value.ids[i] for i in item], items_type),
                        pa.array(score, pa.float64()),
                        pa.array(first, pa.int64()),
                        pa.array(end, pa.int64()),
                    ],
                    schema.names,
                )

        parts.append(df.select(id_col, text_col).mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, parts[1:] or parts)


def _holds_item(block: Broadcast, least: float, text: Column) -> Column:
    """Whether a text holds an item of the block."""

    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(block.value, least)
        for texts in batches:
            found = np.zeros(len(texts), bool)
            for i, *_ in scorer.matches([x or "" for x in texts]):
                found[i] = True
            yield pd.Series(found)
        release_memory()

    return holds(text)


def without_benchmark(
    df: DataFrame,
    benchmark: DataFrame,
    least: float = LEAST_SCORE,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `df` that hold no benchmark item, with all their columns; see benchmark_matches."""
    kept = df
    for block in _blocks(benchmark, item_col, item_text_col):
        shared = df.sparkSession.sparkContext.broadcast(block.rare(pair_frequency(df, block, text_col), least))
        name = fresh_name(df.columns, "holds_item")
        kept = kept.withColumn(name, _holds_item(shared, least, F.col(text_col))).where(~F.col(name)).drop(name)
    return kept
