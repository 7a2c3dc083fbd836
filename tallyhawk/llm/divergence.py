"""How far the sources of a language differ in their words."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import slices, stored

#: Documents of a language that a kept term occurs in at least.
LEAST_DOCUMENTS = 30
#: What each term's count is raised by, and the number that shares are of.
SMOOTHING, UNIT = 5, 1_000_000_000
#: Terms in a report of one group.
MOST_TERMS = 50
#: Entries that a task holds before it hands them on as partial sums.
HELD_ENTRIES, HELD_PAIRS = 400_000, 1_000_000

#: Bytes of terms: ASCII letters, lower-cased, and all of what is not ASCII; the rest parts terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

COUNTS = "lang string, source string, term string, n long, docs long"
PAIRS = "lang string, a string, b string, both long"
COPIES = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): the sources of each language against each other, and their own terms.

    A language keeps the terms of at least `least_documents` of its documents. A group (the documents of a language
    and source, or all of a language) gives a kept term the share 1 + floor(UNIT * (n + 5) / (N + 5 * V)), n being
    its occurrences there, N their sum over the V kept terms. Part `pair`: for each other source of the language,
    the sum of the differences of all kept terms' shares, 0 where nothing is kept. Part `term`: the `most_terms`
    kept terms that stand out most from the language, with the difference. Ranks are by value, then item in UTF-8.

    Null text, language and source count as ''. Equal texts count as often as they occur, repeated rows as
    well; a language's that come in one slice of a task are tokenized once. Integers and decimals only, so results are exact. Other columns are not
    read; an empty table gives an empty result.
    """
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counts = stored(term_counts(named))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_documents).select("lang", "term")
    used = stored(counts.where("n > 0").join(kept, ["lang", "term"], "left_semi").select("lang", "source", "term", "n"))
    groups = stored(_groups(counts, used))
    return _pairs(used, groups).unionByName(_terms(used, groups, most_terms))


def term_counts(named: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of terms, and documents with them; each group has a row with term ''.

    Texts are counted where they are read; what travels is the partial counts of the tasks.
    """
    partial = named.select("lang", "source", "text").mapInArrow(lambda batches: _count(_folded(batches)), COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, copies, text): equal texts of a language in one slice become one row, beside it their number in each source."""
    for batch in slices(batches):
        texts = batch.column("text").dictionary_encode()
        copies: dict[tuple[str, int], Counter] = defaultdict(Counter)
        for lang, source, code in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts.indices.to_pylist(), strict=True):
            copies[lang, code][source] += 1
        counted = [[{"source": source, "n": n} for source, n in own.items()] for own in copies.values()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang for lang, _ in copies], pa.string()),
                pa.array(counted, COPIES),
                texts.dictionary.take(pa.array([code for _, code in copies], pa.int64())),
            ],
            ["lang", "copies", "text"],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the texts of a task, handed on whenever HELD_ENTRIES of them are held."""
    occurrences: dict[tuple[str, str], Counter] = defaultdict(Counter)
    documents: dict[tuple[str, str], Counter] = defaultdict(Counter)
    for batch in slices(batches, 200):
        langs, copies = batch.column("lang").to_pylist(), batch.column("copies").to_pylist()
        for lang, sources, text in zip(langs, copies, batch.column("text"), strict=True):
            found = text.as_buffer().to_pybytes().translate(_TERM_BYTES).split()
            terms = set(found)
            for entry in sources:
                group, times = (lang, entry["source"]), entry["n"]
                if times == 1:
                    occurrences[group].update(found)
                    documents[group].update(terms)
                else:
                    occurrences[group].update({t: n * times for t, n in Counter(found).items()})
                    documents[group].update(dict.fromkeys(terms, times))
                # Whatever its terms, the group occurs.
                documents[group][b""] += times
        if sum(map(len, documents.values())) > HELD_ENTRIES:
            yield from _rows(occurrences, documents)
            occurrences.clear()
            documents.clear()
    yield from _rows(occurrences, documents)


def _rows(occurrences: dict, documents: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), found in documents.items():
        size, own = len(found), occurrences[lang, source]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang], pa.string()).take(pa.array(np.zeros(size, np.int64))),
                pa.array([source], pa.string()).take(pa.array(np.zeros(size, np.int64))),
                pa.array(list(found), pa.binary()).cast(pa.string()),
                pa.array([own.get(t, 0) for t in found], pa.int64()),
                pa.array(list(found.values()), pa.int64()),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + SMOOTHING) / (total + SMOOTHING * kept)), null where nothing is kept."""
    wide = "decimal(38,0)"
    above = F.call_function("div", (n + SMOOTHING).cast(wide) * F.lit(UNIT).cast("decimal(10,0)"), F.nullif(total + SMOOTHING * kept, F.lit(0)).cast(wide))
    return (above + 1).cast("long")


def _groups(counts: DataFrame, used: DataFrame) -> DataFrame:
    """One row per (lang, source) that occurs: total of kept terms, their number in the language, the share of an absent term."""
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # A term of a language is counted once by the least of its sources.
    terms = used.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    groups = counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")))
    return groups.withColumn("absent", _share(zero, F.col("total"), F.col("kept")))


def _pairs(used: DataFrame, groups: DataFrame) -> DataFrame:
    """Differences of all pairs of sources without a row per term and pair.

    If a term occurred in neither source, it would add |x - y|, x and y being the shares of absent terms there. So
    a pair's sum is V |x - y|, plus for each source what its own terms change about that while the other has none,
    plus a correction for the terms that both have. What a source's terms change depends on their count alone, so
    equal counts are summed up first. The corrections are added up in the tasks that hold the terms.
    """
    one = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "kept", F.col("absent").alias("x"))
    other = groups.select("lang", F.col("source").alias("b"), F.col("absent").alias("y"))
    pairs = one.join(other, "lang").where("a <> b")
    tallies = used.groupBy("lang", F.col("source").alias("a"), "n").agg(F.count(F.lit(1)).alias("terms"))
    own = tallies.join(one, ["lang", "a"]).withColumn("p", _share(F.col("n"), F.col("total_a"), F.col("kept"))).join(other, "lang").where("a <> b")
    change = F.col("terms") * (F.abs(F.col("p") - F.col("y")) - F.abs(F.col("x") - F.col("y")))
    alone = own.groupBy("lang", "a", "b").agg(F.sum(change).alias("alone"))
    both = _shared_terms(used, groups)
    turned = [(alone, "a", "b"), (alone, "b", "a"), (both, "a", "b"), (both, "b", "a")]
    zero = F.lit(0).cast("long")
    parts = pairs.select("lang", "a", "b", (F.col("kept") * F.coalesce(F.abs(F.col("x") - F.col("y")), zero)).alias("value"))
    for df, first, second in turned:
        parts = parts.unionByName(df.select("lang", F.col(first).alias("a"), F.col(second).alias("b"), F.col(df.columns[-1]).alias("value")))
    value = parts.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))
    return value.select("lang", "source", F.lit("pair").alias("part"), "item", "value", _rank().alias("rank"))


def _shared_terms(used: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, both) with a < b: the correction for terms that both sources have."""
    shares = used.join(groups, ["lang", "source"]).select(
        "lang", "term", F.struct("source", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), F.col("absent").alias("x")).alias("entry")
    )
    # At most one entry for each source of the language.
    lists = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list("entry")).alias("entries")).where(F.size("entries") > 1)
    return lists.select("lang", "entries").mapInArrow(_correct, PAIRS).groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))


def _correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str, str], int] = defaultdict(int)
    for batch in slices(batches):
        entries = batch.column("entries")
        flat = entries.flatten()
        names = flat.field("source").dictionary_encode()
        langs = batch.column("lang").dictionary_encode()
        source = names.indices.to_numpy().astype(np.int64)
        p, x = flat.field("p").to_numpy(), flat.field("x").to_numpy()
        starts = entries.offsets.to_numpy().astype(np.int64) - int(entries.offsets[0].as_py())
        lengths = np.diff(starts)
        lang = langs.indices.to_numpy().astype(np.int64)
        n, sources = len(names.dictionary), names.dictionary.to_pylist()
        for size in np.unique(lengths):
            own = np.flatnonzero(lengths == size)
            for i in range(size - 1):
                # The i-th entry of these terms against each later one.
                a = np.repeat(starts[own] + i, size - 1 - i)
                b = (starts[own][:, None] + np.arange(i + 1, size)).ravel()
                value = np.abs(p[a] - p[b]) - np.abs(p[a] - x[b]) - np.abs(p[b] - x[a]) + np.abs(x[a] - x[b])
                code = (np.repeat(lang[own], size - 1 - i) * n + source[a]) * n + source[b]
                order = np.argsort(code, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
                sums = np.add.reduceat(value[order], first)
                for c, s in zip(code[order][first].tolist(), sums.tolist(), strict=True):
                    held[langs.dictionary[c // n // n].as_py(), sources[c // n % n], sources[c % n]] += s
        if len(held) > HELD_PAIRS:
            yield _pair_rows(held)
            held.clear()
    yield _pair_rows(held)


def _pair_rows(held: dict[tuple[str, str, str], int]) -> pa.RecordBatch:
    columns = [pa.array([key[k] for key in held], pa.string()) for k in range(3)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(list(held.values()), pa.int64())], ["lang", "a", "b", "both"])


def _terms(used: DataFrame, groups: DataFrame, most_terms: int) -> DataFrame:
    """The terms with the highest share above that of the language; a task passes on the best of each group only."""
    whole = used.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    shares = used.join(groups, ["lang", "source"]).join(whole, ["lang", "term"]).select(
        "lang",
        "source",
        F.col("term").alias("item"),
        (_share(F.col("n"), F.col("total"), F.col("kept")) - _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))).alias("value"),
    )
    ranked = shares.where("value > 0").withColumn("rank", _rank()).where(F.col("rank") <= most_terms)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
