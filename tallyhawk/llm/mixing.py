"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.llm.common import fresh_name, slices, stored

#: A word of a text, as an expression of the library that counts matches.
WORD = r"[^\x20\x09-\x0D]+"
#: How often a source may be taken at most.
MOST_COPIES = 3
#: Weights of the sources in their order, repeated.
WEIGHTS = (1, 2, 3)
#: Documents of a source that meet in one leaf of the tree, and nodes that meet in the next one.
LEAF_ROWS, FAN = 4096, 32
#: Undecided documents of a size class that a node hands on, so that the root can settle large ones by small ones.
OPEN_ROWS = 8

NODE = T.StructType(
    [
        T.StructField("ident", T.StringType()),
        T.StructField("code", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("nodes", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("copies", T.LongType()),
        T.StructField("mass", T.DoubleType()),
    ]
)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    leaf_rows: int = LEAF_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken) for each row of `docs`.

    Sources in code point order, null last, weigh what `weights` says in turn. Each is to give its weight's share
    of all words, `most_copies` times its own at most; what is above goes to the others by weight. A document is
    taken whole, 0 to `most_copies` times: by chance one of the two whole numbers next to its source's target by its
    source's size, such that the source's words come out at the target but for a part of one of its smallest
    documents, or of a larger one where the smaller ones together can't make up for it.

    A null or empty text has size 0 and is never taken, and so does one without words; a source without words has
    target 0. Repeated rows are drawn apart. All draws are hashes of id and text, so that neither the order nor the
    partitions of the rows matter. Other columns are not read; an empty table gives an empty result.
    """
    sized = stored(_sizes(docs, id_col, text_col, source_col))
    sources = _targets(sized, weights, most_copies, leaf_rows)
    # Few sources are broadcast by Spark's own size check; otherwise both sides meet on the source, a hot one split.
    rows = sized.join(sources, F.col("name").eqNullSafe(F.col("source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(rate).cast("long")
    mass = (rate - base) * F.col("size")
    rows = rows.select(
        "ident", "code", "place", F.pmod("code", "nodes").alias("bucket"), "nodes", "size", base.alias("copies"), mass.alias("mass")
    )
    settled = _tree(rows, fan)
    own = docs.schema[id_col].dataType
    return settled.drop("nodes").join(sources, "place").select(
        F.col("ident").cast(own).alias(id_col),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(ident, code, source, size): the words of each text, and a hash that stands for the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = pc.fill_null(pc.count_substring_regex(batch.column("words"), WORD), 0)
            columns = [batch.column(c) for c in ("ident", "code", "source")]
            yield pa.RecordBatch.from_arrays([*columns, pc.cast(counts, pa.int64())], ["ident", "code", "source", "size"])

    named = docs.select(
        F.col(id_col).cast("string").alias("ident"),
        F.xxhash64(id_col, text_col).alias("code"),
        F.col(source_col).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).alias("words"),
    )
    source = docs.schema[source_col].dataType.simpleString()
    return named.mapInArrow(run, f"ident string, code long, source {source}, size long")


def _targets(sized: DataFrame, weights: tuple[int, ...], most_copies: int, leaf_rows: int) -> DataFrame:
    """One row per source: name, place in the order, weight, source_size, target, number of leaves."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n"))
    placed = _numbered(totals, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), (F.col("place") % len(weights)).cast("int") + 1)
    nodes = F.greatest(F.lit(1), F.ceil(F.col("n") / leaf_rows)).cast("long")
    sources = stored(
        placed.select(F.col("source").alias("name"), "place", weight.cast("double").alias("weight"), "source_size", nodes.alias("nodes"))
    )
    level = _water_level(sources, most_copies)
    target = F.least(F.col("weight") * level, F.col("source_size") * F.lit(float(most_copies)))
    return stored(sources.withColumn("target", target))


def _numbered(df: DataFrame, order: Column) -> DataFrame:
    """`df` with `place`, 0 for the first by `order`: ranges are sorted apart, only their sizes reach the driver."""
    part, first = fresh_name(df.columns, "part"), fresh_name(df.columns, "first")
    ranged = stored(df.repartitionByRange(order).withColumn(part, F.spark_partition_id().cast("long")))
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy(part).collect()
    before = np.cumsum([0, *(r["n"] for r in sizes)])
    starts = df.sparkSession.createDataFrame([(r[part], int(b)) for r, b in zip(sizes, before, strict=False)], f"{part} long, {first} long")
    inside = F.row_number().over(Window.partitionBy(part).orderBy(order)) - 1
    return ranged.join(starts, part).select(*df.columns, (F.col(first) + inside).alias("place"))


def _water_level(sources: DataFrame, most_copies: int) -> float:
    """Words per unit of weight: each source gives this times its weight, or all that it may.

    Every round finds the sources that would give more than they may and deals the rest to the others. The level
    only rises and more sources only join, so the rounds end; few do, as each is a sum over one row per source.
    """
    most = F.col("source_size") * most_copies
    level = 0.0
    while True:
        full = most < F.col("weight") * level
        total, given, weight, n_full = sources.agg(
            F.sum("source_size"), F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.count_if(full)
        ).first()
        if not total or not weight:
            return level
        higher = (total - given) / weight
        if higher <= level:
            return level
        level = higher


def _tree(rows: DataFrame, fan: int) -> DataFrame:
    """`rows` with whole `copies`: leaves round their documents, and what stays undecided meets in the next level."""
    undecided = (F.col("size") > 0) & (F.col("mass") > 0)
    done = [rows.where(~undecided).withColumn("copies", F.when(F.col("size") > 0, F.col("copies")).otherwise(F.lit(0)).cast("long"))]
    nodes = rows.where(undecided)
    while True:
        rounded = stored(nodes.groupBy("place", "bucket").applyInPandas(_node, NODE))
        done.append(rounded.where("mass = 0"))
        nodes = rounded.where("mass > 0").withColumns({"bucket": F.floor(F.col("bucket") / fan).cast("long"), "nodes": F.ceil(F.col("nodes") / fan).cast("long")})
        if nodes.isEmpty():
            return reduce(DataFrame.unionByName, done)


def _node(rows: pd.DataFrame) -> pd.DataFrame:
    """One node: its documents with one more copy where they got all their mass; mass is left where undecided."""
    rows = rows.assign(kind=[int(x).bit_length() for x in rows["size"]])
    rows = rows.sort_values(["kind", "code", "size", "mass", "ident"], ascending=[False, True, True, True, True], ignore_index=True)
    sizes = rows["size"].to_numpy()
    draw = random.Random(int(rows["code"].sum())).random
    mass = round_masses(sizes.tolist(), rows["mass"].tolist(), rows["kind"].tolist(), draw, rows["nodes"].iat[0] == 1)
    whole = mass >= sizes
    rows["copies"] += whole
    rows["mass"] = np.where(whole, 0.0, mass)
    return rows[NODE.names]


def round_masses(sizes: list[int], masses: list[float], kinds: list[int], draw: Callable[[], float], root: bool) -> np.ndarray:
    """Masses (size times probability) of the documents of one node, decided ones 0 or the size.

    Rows are in falling order of `kinds`, the number of bits of the size. In a kind, two undecided documents at a
    time pass words from one to the other, at random such that neither's expectation changes, until one of them
    has nothing or all. A node keeps OPEN_ROWS undecided ones of each kind for the next. The root keeps one and
    draws it: what it gains or gives up, all documents of smaller kinds make up for together, and so on down to
    the smallest kind, whose last document's draw is all that the sum is off by.
    """
    mass = list(masses)
    places = [list(own) for _, own in groupby(range(len(sizes)), key=kinds.__getitem__)]
    for k, own in enumerate(places):
        carry = own[0]
        for other in own[1:] if root else own[1 : len(own) - OPEN_ROWS + 1]:
            carry = _pass(sizes, mass, carry, other, draw())
        if root and 0 < mass[carry] < sizes[carry]:
            _pass_to_all(sizes, mass, carry, [x for smaller in places[k + 1 :] for x in smaller], draw)
    return np.array(mass)


def _pass(size: list[int], mass: list[float], i: int, j: int, draw: float) -> int:
    """Move words between two documents until one is decided; returns the other one."""
    if mass[i] <= 0 or mass[i] >= size[i]:
        return j
    up = min(size[i] - mass[i], mass[j])
    down = min(mass[i], size[j] - mass[j])
    if draw * (up + down) < down:
        return _move(size, mass, i, j, up)
    return _move(size, mass, j, i, down)


def _move(size: list[int], mass: list[float], to: int, of: int, words: float) -> int:
    """`words` pass from `of` to `to`; the one that has nothing or all by that gets exactly that, the other is returned."""
    if words == mass[of]:
        mass[to], mass[of] = mass[to] + words, 0.0
        if mass[to] >= size[to]:
            mass[to] = float(size[to])
        return to
    mass[of], mass[to] = mass[of] - words, float(size[to])
    return of


def _pass_to_all(size: list[int], mass: list[float], carry: int, rest: list[int], draw: Callable[[], float]) -> None:
    """Decide `carry` by its own probability; the words that it gains or gives up come from, or go to, all of `rest`.

    They give in proportion to what they have and take in proportion to what they lack. Where they can only do the
    one, that is done; where neither, what comes nearer. With equal probabilities no expectation changes by it.
    """
    total, have = np.array([size[x] for x in rest], float), np.array([mass[x] for x in rest], float)
    gain, loss = size[carry] - mass[carry], mass[carry]
    give, take = float(have.sum()), float((total - have).sum())
    if (gain <= give) == (loss <= take):
        up = draw() * size[carry] < loss if gain <= give else gain - give < loss - take
    else:
        up = gain <= give
    mass[carry] = float(size[carry]) if up else 0.0
    if up and give:
        have = have * max(0.0, 1 - gain / give)
    elif not up and take:
        have = have + (total - have) * min(1.0, loss / take)
    # Sums of doubles that end beside a bound are at it.
    have = np.where(have < 1e-6, 0.0, np.where(total - have < 1e-6, total, have))
    for x, value in zip(rest, have.tolist(), strict=True):
        mass[x] = value
