"""Near duplicates by SimHash fingerprints, compared bit-sliced within blocks that share enough bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tallyhawk.llm.common import checkpointed, fresh_name, slices
from tallyhawk.llm.components import connected_components

WORDS = 3
SEED = 42
RADIUS = 3
#: 64 bits in RADIUS + 2 parts: two fingerprints within the radius agree on two parts at least.
PARTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of one side of a comparison; a larger bucket is compared chunk by chunk, by many tasks.
CHUNK = 1024
#: Pairs of rows that are compared before their links are folded.
PAIRS = 1 << 21
#: (query, word) lanes that one vector step holds.
LANES = 1 << 16

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles as an unsigned number; 0 without words."""
    # bytes.lower() changes A-Z alone, and bytes.split() cuts at blank and 09-0D alone.
    parts = text.encode().lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))
    hashes = np.array([xxh64_intdigest(x, seed) for x in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        block = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """(id, others, fp): the fingerprint's 64 bits as a signed number. A null text has no words."""
    names = [id_col, *others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([fingerprint(x or "") for x in batch.column(text_col).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(prints.view(np.int64))], [*names, "fp"])

    schema = T.StructType([*(T.StructField(x, df.schema[x].dataType) for x in names), T.StructField("fp", T.LongType())])
    return df.select(*names, text_col).mapInArrow(run, schema)


def bucket_keys(fp: str = "fp") -> F.Column:
    """The ten keys of a fingerprint: two of its parts each, with the number of the pair in the low bits."""
    keys = []
    for number, pair in enumerate(combinations(PARTS, 2)):
        key = F.lit(0).cast("long")
        for start, width in pair:
            part = F.shiftrightunsigned(F.col(fp), start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(F.shiftleft(key, 4).bitwiseOR(F.lit(number).cast("long")))
    return F.array(*keys)


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(64, words): bit b of print i is bit i % 64 of word i // 64 of plane b."""
    words = -(-len(prints) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def links_within(prints: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with first[i] <= j < last[i] whose prints differ in at most `radius` (3 at most) bits.

    Each query meets words of 64 prints. Distances are kept as two counter planes and one plane of lanes
    that are beyond the radius, updated by carry-save addition for one bit plane after the other; a word
    is abandoned once all its lanes are beyond.
    """
    planes = bit_planes(prints)
    n_words = np.where(last > first, (last - 1) // 64 - first // 64 + 1, 0)
    ends = np.cumsum(n_words)
    found_i, found_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    low = 0
    while low < len(prints):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + LANES, side="right")))
        query = np.repeat(np.arange(low, high), n_words[low:high])
        step = np.arange(len(query)) - np.repeat(ends[low:high] - n_words[low:high] - (ends[low - 1] if low else 0), n_words[low:high])
        word = first[query] // 64 + step
        low = high
        # Lanes outside [first, last) count as beyond from the start.
        start = np.clip(first[query] - 64 * word, 0, 64).astype(np.uint64)
        stop = np.clip(last[query] - 64 * word, 0, 64).astype(np.uint64)
        inside = _low_bits(stop) & ~_low_bits(start)
        beyond = ~inside
        one = np.zeros(len(query), np.uint64)
        two = np.zeros(len(query), np.uint64)
        bits = prints[query]
        for plane in range(64):
            if plane % 8 == 0 and plane:
                alive = beyond != ONES
                if not alive.all():
                    query, word, beyond, one, two, bits = (x[alive] for x in (query, word, beyond, one, two, bits))
                if not len(query):
                    break
            asked = np.where((bits >> np.uint64(plane)) & np.uint64(1), ONES, np.uint64(0))
            differs = planes[plane][word] ^ asked
            carry = one & differs
            one ^= differs
            beyond |= two & carry
            two ^= carry
        if radius < 3:
            beyond |= (two & one) if radius == 2 else two if radius == 1 else (two | one)
        hit = np.flatnonzero(beyond != ONES)
        lanes = np.unpackbits((~beyond[hit]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(lanes)
        found_i.append(query[hit][row])
        found_j.append(64 * word[hit][row] + lane)
    return np.concatenate(found_i), np.concatenate(found_j)


def _low_bits(n: np.ndarray) -> np.ndarray:
    return np.where(n >= 64, ONES, (np.uint64(1) << (n % np.uint64(64))) - np.uint64(1))


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that links connect it to."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        new = np.minimum(new, new[label])
        while (jumped := new[new]).tolist() != new.tolist():
            new = jumped
        if (new == label).all():
            break
        label = new
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def _cell_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning links of cells; a cell's rows follow one another, and a cell is bounded by two chunks."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        rows = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        cell = rows[["key", "low", "high"]].to_numpy()
        same = (cell == cell[-1]).all(axis=1) if len(cell) else np.zeros(0, bool)
        cut = len(rows) if not len(rows) else int(np.flatnonzero(~same)[-1] + 1) if not same.all() else 0
        rest = rows.iloc[cut:]
        if cut:
            yield from _spanning(rows.iloc[:cut])
    if rest is not None and len(rest):
        yield from _spanning(rest)


def _spanning(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Links of whole cells, of so many at a time that even links between all rows would fit into memory."""
    sizes = rows.groupby(["key", "low", "high"], sort=False).size().to_numpy()
    share = np.cumsum(sizes.astype(np.int64) ** 2) // (2 * PAIRS)
    ends = np.cumsum(sizes)[np.flatnonzero(np.append(share[1:] != share[:-1], True))]
    for start, end in zip(np.append(0, ends[:-1]), ends, strict=True):
        yield _links_of(rows.iloc[start:end])


def _links_of(rows: pd.DataFrame) -> pd.DataFrame:
    cell = rows[["key", "low", "high"]].to_numpy()
    new = np.concatenate([[True], (cell[1:] != cell[:-1]).any(axis=1)])
    starts = np.flatnonzero(new)
    index = np.arange(len(rows))
    first = starts[np.cumsum(new) - 1]
    # Within a cell only later rows are compared, so each pair is met once.
    last = np.append(starts[1:], len(rows))[np.cumsum(new) - 1]
    prints = rows["fp"].to_numpy().view(np.uint64)
    nodes = rows["node"].to_numpy()
    i, j = links_within(prints, np.minimum(index + 1, last), last)
    label = smallest_linked(len(rows), i, j)
    linked = label != index
    assert (first <= label).all()
    return pd.DataFrame({"a": nodes[index[linked]], "b": nodes[label[linked]]})


def fingerprint_links(nodes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links that join all `nodes` (node, fp), fp unique, of prints within the radius into their groups.

    Every pair within the radius shares one of ten keys, and is compared there. A bucket of more than
    `chunk` prints is dealt out to cells of two chunks, so that no task holds more than two chunks of it.
    A cell returns at most one link per row.
    """
    keyed = nodes.select("node", "fp", F.explode(bucket_keys()).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / chunk)
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    cells = (
        keyed.join(sizes, "key")
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp", "node")
    )
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(partitions, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInPandas(_cell_links, "a long, b long").where("a <> b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, fingerprint, component_id): the group of each row of `df` by SimHash of its text.

    Texts are lower-cased in A-Z and cut at ASCII white space; fingerprints within RADIUS bits are linked,
    and a group's id is its smallest id. The id column holds whole numbers. Texts without words, null
    among them, have the fingerprint 0 and are linked as any other. Equal fingerprints are folded first, so
    exact copies cost one comparison, whatever their number. Repeated rows give repeated results; a row with
    a null id gets a fingerprint and a null component and links nothing. An empty table gives an empty
    result. Other columns are not read.
    """
    prints = checkpointed(with_fingerprint(df, id_col, text_col).withColumnRenamed(id_col, "id"))
    nodes = checkpointed(prints.where("id IS NOT NULL").groupBy("fp").agg(F.min(F.col("id").cast("long")).alias("node")))
    components = connected_components(fingerprint_links(nodes, chunk))
    members = nodes.join(components, "node", "left").select(
        F.col("fp").alias("member_fp"), F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(members, F.col("fp") == F.col("member_fp"), "left").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` without near duplicates: of each group the row with the smallest id, all columns kept.

    Rows with one id and text are one row. Rows with one id and different texts are told apart by the texts: each goes or
    stays as its own text says. Rows with a null id belong to no group and stay.
    """
    code = fresh_name(df.columns, "text_code")
    named = df.where(F.col(id_col).isNotNull()).withColumn(code, F.xxhash64(text_col))
    rows = named.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(code).alias("code"))
    prints = checkpointed(with_fingerprint(rows, "id", "text", "code"))
    # Prints are nodes here, not ids, so that texts of one id don't link their groups.
    nodes = checkpointed(prints.select("fp").distinct().withColumn("node", F.col("fp")))
    components = connected_components(fingerprint_links(nodes))
    grouped = prints.join(components, F.col("fp") == F.col("node"), "left").withColumn("component", F.coalesce("component", "fp"))
    first = grouped.groupBy("component").agg(F.min(F.struct("id", "code")).alias("first"))
    stays = first.select(F.col("first.id").alias("stays_id"), F.col("first.code").alias("stays_code"))
    same = (named[id_col] == stays["stays_id"]) & (named[code] == stays["stays_code"])
    kept = named.join(stays, same, "left_semi").dropDuplicates([id_col, code]).drop(code)
    return kept.unionByName(df.where(F.col(id_col).isNull()))
