"""Removal of repeated passages: every word in a window of words that also starts earlier in the corpus."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyhawk.llm.common import byte_balanced, fresh_name, release_memory, slices, stored
from tallyhawk.llm.word_hashes import hash_words, mixed

WINDOW = 20
#: Words of a mark: each window is known by the one with the lowest hash of its sequences of so many words.
MARK_WORDS = 6
#: Bytes of text that share an automaton.
SHARD_BYTES = 4 << 20
#: Texts hashed at a time.
HASH_BYTES = 1 << 19
#: A null id counts as smaller than every other.
NULL_ID = -(1 << 63)

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def stretches(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one mark, as arrays (text, first window, windows, mark, words).

    `mark` is the hash of the mark's words, `words` that of all words of the run and of the mark's place in it. A window's mark
    depends on its words alone (the first of equal hashes counts), so equal windows have equal marks.
    """
    words = hash_words(texts)
    n = len(words.hashes)
    if n < window:
        return tuple(np.empty(0, np.int64) for _ in range(3)) + tuple(np.empty(0, np.uint64) for _ in range(2))
    at = np.arange(n - MARK_WORDS + 1)
    marks = words.spans(at, at + MARK_WORDS)
    choice = window - MARK_WORDS + 1
    places = np.lib.stride_tricks.sliding_window_view(marks, choice).argmin(axis=1)
    start = np.arange(n - window + 1)
    text = np.searchsorted(words.offsets, start, side="right") - 1
    whole = start + window <= words.offsets[text + 1]
    start, text = start[whole], text[whole]
    if not len(start):
        return stretches([], window)
    place = start + places[start]
    new = np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(start)))
    begin = start[first]
    spans = words.spans(begin, begin + counts + window - 1) ^ mixed((place[first] - begin).astype(np.uint64))
    return text[first], begin - words.offsets[text[first]], counts, marks[place[first]], spans


def _stretch_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(mark, words, id, place): place is the number of the first window times 32 and the windows after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            ids = batch.column("id").to_numpy()
            for low, high in byte_balanced(texts, HASH_BYTES):
                text, first, counts, mark, words = stretches(texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mark.view(np.int64)), pa.array(words.view(np.int64)), pa.array(ids[low + text]), pa.array(first * 32 + counts - 1)],
                    ["mark", "words", "id", "place"],
                )

    return df.select(_id(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "mark long, words long, id long, place long")


def _id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))


def _shard(ident: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(ident), F.lit(shards)).cast("int")


def _window_rows(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(window, id, start): the hash of every window in the stretches `wanted` (shard, id, place)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(3)]
        if right.num_rows:
            ids, places = right["id"].to_numpy(), right["place"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, places = ids[order], places[order]
            for ident, text in zip(left["_id"].to_pylist(), left["_text"].to_pylist(), strict=True):
                low, high = np.searchsorted(ids, ident), np.searchsorted(ids, ident, side="right")
                if low == high:
                    continue
                words = hash_words([(text or "").encode()])
                first, counts = places[low:high] // 32, places[low:high] % 32 + 1
                starts = np.unique(np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
                # Of rows that share an id, some may be shorter.
                starts = starts[starts + WINDOW < len(words.hashes) + 1]
                out[0].append(words.spans(starts, starts + WINDOW).view(np.int64))
                out[1].append(np.full(len(starts), ident, np.int64))
                out[2].append(starts)
        return pa.table([pa.array(np.concatenate(x)) for x in out], names=["window", "id", "start"])

    return texts.groupBy("_shard").cogroup(wanted.groupBy("shard")).applyInArrow(run, "window long, id long, start long")


def passage_claims(df: DataFrame, texts: DataFrame, shards: int, id_col: str, text_col: str) -> DataFrame:
    """(shard, id, start, n, head_id, head_start): passages that recur, one witness for each shard of documents.

    A passage of n words stands at (id, start), a document of the shard, and first of all at (head_id, head_start).
    Every window that also starts earlier lies in an occurrence of such a passage in its shard. A passage in a third
    of all documents is claimed once per shard, not once per document.

    Stretches recur as a whole in copies; these are settled by the first place of each. Where one mark has several
    stretches, their windows are compared one by one.
    """
    rows = _stretch_rows(df, id_col, text_col)
    # Windows can be equal only if their marks are, so marks that occur once are left out first, by the cheapest rows.
    # They are stored, so that the join can split a mark that many documents have.
    recurring = stored(rows.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark"))
    # A stretch that many documents have goes on as one row for each shard that has it.
    folded = stored(
        rows.join(recurring, "mark")
        .groupBy(_shard(F.col("id"), shards).alias("shard"), "words")
        .agg(F.min(F.struct("id", "place")).alias("own"), F.count(F.lit(1)).alias("n"), F.max("mark").alias("mark"))
    )
    heads = stored(folded.groupBy("words").agg(F.min("own").alias("head"), F.sum("n").alias("n"), F.max("mark").alias("mark")))
    repeated = heads.where("n > 1").select("words", F.col("head.id").alias("head_id"), F.col("head.place").alias("head_place"))
    copies = (
        folded.select("shard", "words", "own", "n")
        .join(repeated, "words")
        .where("n > 1 OR own.id <> head_id OR own.place <> head_place")
        .select(
            "shard",
            "own.id",
            F.shiftright("own.place", 5).alias("start"),
            (F.col("own.place").bitwiseAND(F.lit(31)) + WINDOW).alias("n"),
            "head_id",
            F.shiftright("head_place", 5).alias("head_start"),
        )
    )
    several = stored(heads.groupBy("mark").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1").select("mark"))
    unsettled = heads.join(several, "mark").select("head.id", "head.place")
    windows = _window_rows(texts, unsettled.select(_shard(F.col("id"), shards).alias("shard"), "id", "place"))
    inside = stored(
        windows.groupBy(_shard(F.col("id"), shards).alias("shard"), "window").agg(
            F.min(F.struct("id", "start")).alias("own"), F.count(F.lit(1)).alias("n")
        )
    )
    first = inside.groupBy("window").agg(F.min("own").alias("head"), F.sum("n").alias("n")).where("n > 1")
    parts = (
        inside.join(first.select("window", F.col("head.id").alias("head_id"), F.col("head.start").alias("head_start")), "window")
        .where("n > 1 OR own.id <> head_id OR own.start <> head_start")
        .select("shard", "own.id", "own.start", F.lit(WINDOW).cast("long").alias("n"), "head_id", "head_start")
    )
    return copies.unionByName(parts)


def _removed(docs: list[tuple[int, list[bytes]]], claims: dict[str, list[int]]) -> list[np.ndarray | None]:
    """For each document of a shard which of its words are removed, or None.

    The claimed passages become one automaton over the words of the shard; all documents stream through it. Words are
    told apart by their bytes, so that passages match as texts, not as hashes.
    """
    if not claims["id"]:
        return [None] * len(docs)
    by_id: dict[int, list[int]] = {}
    for i, (ident, _) in enumerate(docs):
        by_id.setdefault(ident, []).append(i)
    # Words of passages have numbers from 1; all others are 0, which no passage holds.
    numbers: dict[bytes, int] = {}
    heads: dict[tuple[int, ...], tuple[int, int]] = {}
    for ident, start, n, head_id, head_start in zip(*(claims[x] for x in ("id", "start", "n", "head_id", "head_start")), strict=True):
        for i in by_id.get(ident, ()):
            words = docs[i][1][start : start + n]
            if len(words) == n:
                passage = tuple([numbers.setdefault(w, len(numbers) + 1) for w in words])
                head = (head_id, head_start)
                heads[passage] = min(head, heads.get(passage, head))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for passage, head in heads.items():
        automaton.add_word(passage, (len(passage), head))
    automaton.make_automaton()
    removed: list[np.ndarray | None] = []
    for ident, words in docs:
        edge = None
        codes = np.fromiter(map(numbers.get, words, repeat(0)), np.int64, len(words))
        bounds = np.concatenate([[-1], np.flatnonzero(codes == 0), [len(codes)]])
        # Only stretches of so many words of passages can hold one.
        for k in np.flatnonzero(np.diff(bounds) > WINDOW).tolist():
            low = int(bounds[k]) + 1
            for end, (n, head) in automaton.iter(tuple(codes[low : bounds[k + 1]].tolist())):
                start = low + end - n + 1
                if head < (ident, start):
                    if edge is None:
                        edge = np.zeros(len(words) + 1, np.int32)
                    edge[start] += 1
                    edge[low + end + 1] -= 1
        removed.append(None if edge is None else np.cumsum(edge[:-1]) > 0)
    return removed


def _without(text: bytes, gone: np.ndarray) -> bytes:
    """A text without some of its words and the white space behind them."""
    starts = [m.start() for m in WORD.finditer(text)]
    ends = [*starts[1:], len(text)]
    kept, at = [], 0
    for run in np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).reshape(-1, 2):
        kept.append(text[at : starts[run[0]]])
        at = ends[run[1] - 1]
    kept.append(text[at:])
    return b"".join(kept)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of `df` with repeated passages cut from their texts, and n_words, n_removed, kept_sha256.

    Words are what blanks and 09-0D part. A word goes if some window of WINDOW words that covers it has the same words
    as one that starts earlier: in a document with a smaller id, or further ahead in the same one. Windows are those of the
    input, whatever else goes. The cut takes the white space behind a word along; a text without repeats stays as it is.
    kept_sha256 is of the kept words, joined by single blanks. Names that `df` has already get underscores before them.

    A null text has no words and stays null. A null id counts as the smallest. The id column holds whole numbers. Rows that share
    an id count as one another's equals: the same window at the same place of both is no repeat, at a later place it is.
    An empty table gives an empty result. Hashes only propose passages, words decide; two stretches with one 64-bit hash
    could hide an earlier occurrence, never remove a unique one.
    """
    names = [fresh_name(df.columns, x) for x in ("n_words", "n_removed", "kept_sha256")]
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = int(total // shard_bytes) + 1
    own = {c: f"c{i}" for i, c in enumerate(df.columns)}
    # Under names of its own, for columns of the caller may be called anything.
    carried = df.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items()))
    texts = carried.select(
        "*", _id(own[id_col]).alias("_id"), F.col(own[text_col]).alias("_text"), _shard(_id(own[id_col]), shards).alias("_shard")
    ).drop(own[text_col])
    claims = passage_claims(carried, texts, shards, own[id_col], own[text_col])
    fields = [T.StructField(own[f.name], f.dataType) for f in df.schema.fields]
    schema = T.StructType(
        [*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    )
    arrow = to_arrow_schema(schema)
    text_name = own[text_col]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        raw = [None if x is None else x.encode() for x in left["_text"].to_pylist()]
        docs = [(ident, (x or b"").split()) for ident, x in zip(left["_id"].to_pylist(), raw, strict=True)]
        gone = _removed(docs, right.select(["id", "start", "n", "head_id", "head_start"]).to_pydict())
        text, sha, lost = [], [], []
        for x, (_, words), drop in zip(raw, docs, gone, strict=True):
            kept = words if drop is None else [w for w, d in zip(words, drop.tolist(), strict=True) if not d]
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            lost.append(len(words) - len(kept))
            text.append(x if drop is None or x is None else _without(x, drop))
        release_memory()
        made = {
            text_name: pa.array([None if x is None else x.decode() for x in text], pa.string()),
            "n_words": pa.array([len(w) for _, w in docs], pa.int64()),
            "n_removed": pa.array(lost, pa.int64()),
            "kept_sha256": pa.array(sha, pa.string()),
        }
        return pa.table([made[f.name] if f.name in made else left[f.name] for f in arrow], names=arrow.names).cast(arrow)

    result = texts.groupBy("_shard").cogroup(claims.groupBy("shard")).applyInArrow(run, schema)
    back = [F.col(n).alias(c) for c, n in own.items()]
    return result.select(*back, *(F.col(a).alias(b) for a, b in zip(("n_words", "n_removed", "kept_sha256"), names, strict=True)))
