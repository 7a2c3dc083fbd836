"""Toxicity by weak supervision: many voters, a generative label model over their votes, a linear classifier.

Voters are word lists, patterns, and word beginnings mined from labelled rows: some tell where they stand once, others, that
clean texts have now and then, where they come again in the same text. The label model is a mixture of two
classes in which each vote depends on the class and on one other vote, so that it learns how accurate voters are
and which of them repeat each other. Its posteriors are the labels of a logistic regression over the votes and
hashed words, which scores every text.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import fresh_name, lowest_hashes, release_memory, slices, text_column

# Words that insult or demean, by kind.
LEXICONS: dict[str, tuple[str, ...]] = {
    "persons": ("idiot", "moron", "loser", "clown", "fool", "jerk", "imbecile", "creep", "freak", "liar", "coward"),
    "contempt": ("pathetic", "worthless", "disgusting", "useless", "despicable", "repulsive", "vile", "hideous"),
    "refuse": ("scum", "trash", "garbage", "filth", "vermin", "parasite", "maggot"),
    "stupidity": ("stupid", "dumb", "brainless", "retarded", "moronic", "idiotic"),
    "hostility": ("hate", "hatred", "despise", "shut", "die", "kill", "loathe"),
}
#: Words by which a text speaks to somebody.
ADDRESS = frozenset("you your youre yourself u du dich ihr euch tu toi vous usted eres te".split())
PATTERNS = ("addressed", "dense", "capitals", "exclaiming")
#: Voters that share the mined word beginnings, those that share the beginnings that come again, and how many of either
#: kind are mined at most, the surest first.
MINED_VOTERS, AGAIN_VOTERS, MINED_STEMS = 6, 3, 60
#: Marks a beginning that has to come again.
AGAIN = "2 "
STEM_LENGTHS = (4, 5, 6)
#: How sure a mined beginning must be: log-likelihood ratio, and the share of toxic rows among those that have it.
LEAST_RATIO, LEAST_PRECISION, LEAST_PRECISION_AGAIN = 30.0, 0.9, 0.8
#: Rows that a task's counter of beginnings may hold before it passes them on.
STEMS_HELD = 200_000
#: Labelled rows of each class that a model is fitted on, those with the lowest hash of the id.
ROWS_PER_CLASS = 6000
#: Rows without a label that the classifier learns from by their posteriors, and their weight beside all labelled rows.
FREE_ROWS, FREE_WEIGHT = 3000, 0.25
VOTERS = (*LEXICONS, *PATTERNS, *(f"mined {i}" for i in range(MINED_VOTERS)), *(f"again {i}" for i in range(AGAIN_VOTERS)))
#: Place of the first mined voter.
FIRST_MINED = len(LEXICONS) + len(PATTERNS)
#: Accuracy that a given label has as one more voter.
LABEL_ACCURACY = 0.97
#: Log-odds by which votes can speak against a given label: voters of other languages stay silent, and don't overrule it.
MOST_AGAINST = 2.0
#: Stands for the label of a row that has none.
FREE = -1
HASH_BITS = 17
#: How strongly the classifier's weights of words are drawn to 0: votes shall tell, words the rest.
WORD_DECAY = 1e-4
THRESHOLD = 0.7
#: Tokens kept in a task's memory, and the longest that is kept for long.
MEMO_TOKENS, MEMO_CHARS = 300_000, 40
#: A token's number: bits that count its buckets, below its weight in parts of a unit.
COUNT_BITS, WEIGHT_UNIT = 32, 1 << 30

WORD = re.compile(r"[^\W\d_]+")


class KnownTokens(dict):
    """What is known of tokens, as one number each, so that a text's tokens add up to all that its score needs.

    The low bits count a token's hash buckets, the high ones are its weight in fixed point; sums of such numbers
    don't depend on the order of tokens. Tokens in which a word voter fires are in `fired`, with the voters' bits; tokens that
    have beginnings which tell when they come again are in `again`, with these.
    There are two generations: a token that is looked up stays, one that isn't goes with the older of them.
    """

    def __init__(self, stems: dict[str, int], weights: np.ndarray | None = None):
        super().__init__()
        self.weights = None if weights is None else weights.tolist()
        self.stems = {stem: i for stem, i in stems.items() if not stem.startswith(AGAIN)}
        self.again_stems = {stem[len(AGAIN) :]: i for stem, i in stems.items() if stem.startswith(AGAIN)}
        self.beginnings = {stem[: STEM_LENGTHS[0]] for stem in (*self.stems, *self.again_stems)}
        self.older: dict[str, int] = {}
        self.fired: dict[str, int] = {}
        self.again: dict[str, list[str]] = {}

    def __missing__(self, token: str) -> int:
        known = self.older.get(token)
        if known is None:
            known = self._look_up(token)
        self[token] = known
        return known

    def _look_up(self, token: str) -> int:
        words = [token] if token.isalpha() else WORD.findall(token)
        bits, again = 0, []
        for word in words:
            bits |= _LEXICON_BITS.get(word, 0)
            for stem in stems_of(word) if word[: STEM_LENGTHS[0]] in self.beginnings else ():
                if stem in self.stems:
                    bits |= 1 << (FIRST_MINED + self.stems[stem])
                if stem in self.again_stems:
                    again.append(stem)
        if bits:
            self.fired[token] = bits
        if again:
            self.again[token] = again
        if self.weights is None:
            return 0
        places = buckets_of(words)
        return (round(sum(self.weights[b] for b in places) * WEIGHT_UNIT) << COUNT_BITS) + len(places)

    def age(self) -> None:
        """Begin a new generation where this one is full, and let go of tokens too long to be met again."""
        if len(self) > MEMO_TOKENS // 2:
            self.older = {token: known for token, known in self.items() if len(token) <= MEMO_CHARS}
            self.clear()
            self.fired = {token: bits for token, bits in self.fired.items() if token in self.older}
            self.again = {token: stems for token, stems in self.again.items() if token in self.older}


def buckets_of(words: list[str]) -> list[int]:
    """Hash buckets of the words of a token and of their beginnings."""
    return [zlib.crc32(x.encode()) >> (32 - HASH_BITS) for word in words for x in {word, word[:5]}]


class Votes:
    """Which voters fire on a text."""

    def __init__(self, stems: dict[str, int], weights: np.ndarray | None = None):
        self.known = KnownTokens(stems, weights)

    def of(self, text: str) -> tuple[int, int, set[str]]:
        """The votes as bits, the sum of what is known of the distinct tokens, and these."""
        self.known.age()
        tokens = text.lower().split()
        distinct = set(tokens)
        total = sum(map(self.known.__getitem__, distinct))
        bits, first = 0, len(LEXICONS)
        hits = self.known.fired.keys() & distinct
        if hits:
            for token in hits:
                bits |= self.known.fired[token]
            places = [i for i, x in enumerate(tokens) if x in hits]
            near = set().union(*(tokens[max(0, i - 5) : i + 6] for i in places))
            if any(word in ADDRESS for x in near for word in WORD.findall(x)):
                bits |= 1 << first
            if len(places) >= 3:
                bits |= 1 << (first + 1)
        once_or_more = self.known.again.keys() & distinct
        if once_or_more:
            times = Counter(stem for x in tokens if x in once_or_more for stem in self.known.again[x])
            for stem, n in times.items():
                if n >= 2:
                    bits |= 1 << (FIRST_MINED + MINED_VOTERS + self.known.again_stems[stem])
        if len(tokens) >= 5 and text.isupper():
            bits |= 1 << (first + 2)
        if text.count("!!") >= 3:
            bits |= 1 << (first + 3)
        return bits, total, distinct


_LEXICON_BITS = {word: 1 << i for i, words in enumerate(LEXICONS.values()) for word in words}


def stems_of(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word[:n] for n in STEM_LENGTHS if len(word) > n] + [word]


@dataclass
class LabelModel:
    """P(toxic), and for each class the probability of each vote given the vote of its parent voter."""

    prior: float
    parents: np.ndarray
    #: (class, voter, vote of the parent)
    fires: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """log P(toxic | votes) - log P(not toxic | votes) of rows of 0/1 votes."""
        return self._log_joint(votes, 1) - self._log_joint(votes, 0)

    def _log_joint(self, votes: np.ndarray, label: int) -> np.ndarray:
        of_parent = np.where(self.parents >= 0, votes[:, self.parents], 0)
        p = self.fires[label][np.arange(votes.shape[1]), of_parent]
        return np.log(self.prior if label else 1 - self.prior) + np.log(np.where(votes == 1, p, 1 - p)).sum(axis=1)


def vote_matrix(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(len(VOTERS))) & 1


def fit_label_model(
    masks: np.ndarray, counts: np.ndarray, gold: tuple[np.ndarray, np.ndarray], prior: float, rounds: int = 40
) -> LabelModel:
    """Expectation maximisation over `counts` of vote patterns and the patterns of rows with a known label.

    `gold` has (pattern, label) of labelled rows; they are weighted to the class shares of `prior`, and patterns
    without labels weigh no more than they do in all, so that the classes keep their meaning.
    """
    patterns, labels = gold
    size = max(len(patterns), 1)
    shares = np.array([1 - prior, prior])
    own = np.array([max((labels == y).sum(), 1) for y in (0, 1)])
    gold_weight = size * (shares / own)[labels] if len(labels) else np.empty(0)
    free_weight = counts * min(1.0, size / max(counts.sum(), 1))
    votes = vote_matrix(np.concatenate([masks, patterns]))
    said = np.concatenate([np.full(len(masks), 0.5), np.where(labels == 1, LABEL_ACCURACY, 1 - LABEL_ACCURACY)])
    label_odds = np.log(said / (1 - said))
    weight = np.concatenate([free_weight, gold_weight])
    # To begin with, labelled rows are what their labels say, others toxic if a lexicon fires.
    lexical = votes[:, : len(LEXICONS)].any(axis=1)
    toxic = np.where(label_odds != 0, said, np.where(lexical, 0.9, prior / 2))
    model = _maximise(votes, weight, toxic)
    for _ in range(rounds):
        fresh = posterior(model.log_odds(votes), label_odds)
        moved = np.abs(fresh - toxic).max(initial=0)
        toxic = fresh
        model = _maximise(votes, weight, toxic)
        if moved < 1e-6:
            break
    return model


def posterior(odds: np.ndarray, label_odds: np.ndarray | float) -> np.ndarray:
    """P(toxic) by the votes' log-odds and those of a given label, which are 0 where there is none."""
    odds = np.where(label_odds != 0, np.clip(odds, -MOST_AGAINST, MOST_AGAINST), odds)
    return 1 / (1 + np.exp(-np.clip(odds + label_odds, -40, 40)))


def _maximise(votes: np.ndarray, weight: np.ndarray, toxic: np.ndarray) -> LabelModel:
    """Vote probabilities along the tree of voters that share the most information within the classes."""
    n = votes.shape[1]
    pair_counts = []
    for share in (1 - toxic, toxic):
        w = weight * share
        on = votes * w[:, None]
        both = votes.T @ on
        one = on.sum(axis=0)
        total = w.sum() + 1.0
        # Smoothed counts of (vote j, vote k): a row is added, spread as if voters rarely fired.
        table = np.empty((n, n, 2, 2))
        table[:, :, 1, 1] = both + 0.01
        table[:, :, 1, 0] = one[:, None] - both + 0.09
        table[:, :, 0, 1] = one[None, :] - both + 0.09
        table[:, :, 0, 0] = total - 0.19 - one[:, None] - one[None, :] + both
        pair_counts.append(np.maximum(table, 1e-9))
    information = sum(_information(x) for x in pair_counts)
    parents, joined = np.full(n, -1), [0]
    rest = set(range(1, n))
    while rest:
        parent, child = max(((p, c) for p in joined for c in rest), key=lambda e: (information[e[0], e[1]], -e[0], -e[1]))
        parents[child] = parent
        joined.append(child)
        rest.remove(child)
    fires = np.empty((2, n, 2))
    for y, table in enumerate(pair_counts):
        for j in range(n):
            p = parents[j] if parents[j] >= 0 else j
            given = table[p, j]
            fires[y, j] = given[:, 1] / given.sum(axis=1) if parents[j] >= 0 else table[j, j, 1, 1] / (table[j, j, 1, 1] + table[j, j, 0, 0])
    mass = weight.sum()
    prior = float(np.clip((weight * toxic).sum() / mass if mass else 0.1, 1e-4, 1 - 1e-4))
    return LabelModel(prior, parents, np.clip(fires, 1e-6, 1 - 1e-6))


def _information(table: np.ndarray) -> np.ndarray:
    mass = table.sum(axis=(2, 3), keepdims=True)
    p = table / mass
    rows, columns = p.sum(axis=3, keepdims=True), p.sum(axis=2, keepdims=True)
    return (mass[..., 0, 0]) * (p * np.log(p / (rows * columns))).sum(axis=(2, 3))


def fit_linear(
    votes: np.ndarray, lengths: np.ndarray, buckets: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 120
) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic regression on soft labels: bias, weights of votes, weights of hash buckets.

    A row's buckets share a length of one, so that long texts gain nothing by having many words.
    """
    n, size = len(target), 1 << HASH_BITS
    filled = np.flatnonzero(lengths)
    starts = (np.cumsum(lengths) - lengths)[filled]
    scale = 1 / np.sqrt(np.maximum(lengths, 1))
    w_bias, w_votes, w_words = 0.0, np.zeros(votes.shape[1]), np.zeros(size)
    state = [[np.zeros_like(np.asarray(x, float)) for x in (w_bias, w_votes, w_words)] for _ in range(2)]
    weight = weight / max(weight.sum(), 1e-9)
    for step in range(1, rounds + 1):
        words = np.zeros(n)
        if len(filled):
            words[filled] = np.add.reduceat(w_words[buckets], starts) * scale[filled]
        p = 1 / (1 + np.exp(-np.clip(w_bias + votes @ w_votes + words, -40, 40)))
        error = (p - target) * weight
        grads = (
            error.sum(),
            votes.T @ error + 1e-5 * w_votes,
            np.bincount(buckets, weights=np.repeat(error * scale, lengths), minlength=size) + WORD_DECAY * w_words,
        )
        values = []
        for k, (value, grad) in enumerate(zip((w_bias, w_votes, w_words), grads, strict=True)):
            state[0][k] = 0.9 * state[0][k] + 0.1 * grad
            state[1][k] = 0.99 * state[1][k] + 0.01 * np.square(grad)
            rate = 0.15 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            values.append(value - rate * state[0][k] / (np.sqrt(state[1][k]) + 1e-8))
        w_bias, w_votes, w_words = float(values[0]), values[1], values[2]
    return w_bias, w_votes, w_words


@dataclass
class ToxicityModel:
    stems: dict[str, int]
    bias: float
    votes: np.ndarray
    words: np.ndarray
    labels: LabelModel


class Scorer:
    """Scores texts with a model, one text after the other."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.voters = Votes(model.stems, model.words)

    def score(self, text: str) -> float:
        bits, total, _ = self.voters.of(text)
        n = total & ((1 << COUNT_BITS) - 1)
        logit = self.model.bias + (total >> COUNT_BITS) / WEIGHT_UNIT / math.sqrt(max(n, 1))
        logit += sum(w for j, w in enumerate(self.model.votes) if bits >> j & 1)
        return 1 / (1 + math.exp(-min(max(float(logit), -40.0), 40.0)))


def mined_stems(rows: DataFrame, text_col: str, label_col: str, most: int = MINED_STEMS) -> dict[str, int]:
    """Word beginnings that mark toxic rows, and the voter of each among those of its kind; from all rows given.

    A beginning behind the mark `AGAIN` tells where it stands twice or more. At most `most` of either kind are mined.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        seen = [0, 0]
        for batch in slices(batches):
            for text, label in zip(text_column(batch, text_col), batch.column(label_col).to_pylist(), strict=True):
                times = Counter(x for w in WORD.findall(text.lower()) for x in stems_of(w) if len(x) <= MEMO_CHARS)
                held[label].update(times.keys())
                held[label].update(AGAIN + x for x, n in times.items() if n >= 2)
                seen[label] += 1
                if len(held[0]) + len(held[1]) > STEMS_HELD:
                    yield _stem_rows(held, seen)
                    held, seen = (Counter(), Counter()), [0, 0]
        yield _stem_rows(held, seen)

    counted = rows.select(text_col, label_col).mapInArrow(count, "stem string, clean long, toxic long")
    sums = counted.groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = counted.where("stem = ''").agg(F.sum("clean"), F.sum("toxic")).first()
    clean, toxic = (total[0] or 0, total[1] or 0) if total else (0, 0)
    if not clean or not toxic:
        return {}
    n = F.col("toxic") + F.col("clean")
    rate = toxic / (toxic + clean)
    # The log-likelihood ratio of the rows that have the beginning.
    ratio = 2 * (
        F.when(F.col("toxic") > 0, F.col("toxic") * F.log(F.col("toxic") / (n * rate))).otherwise(0)
        + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - rate)))).otherwise(0)
    )
    least = F.when(F.startswith("stem", F.lit(AGAIN)), LEAST_PRECISION_AGAIN).otherwise(LEAST_PRECISION)
    sure = (
        sums.where((F.col("stem") != "") & (F.col("toxic") >= least * n))
        .withColumn("ratio", ratio)
        .where(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), F.desc(F.length("stem")), "stem")
        .limit(100 * most)
        .collect()
    )
    once: list[str] = []
    again: list[str] = []
    for stem in (row[0] for row in sure if not row[0].startswith(AGAIN)):
        if len(once) < most and not any(stem.startswith(x) or x.startswith(stem) for x in once):
            once.append(stem)
    alone = {row[0] for row in sure}
    for stem in (row[0][len(AGAIN) :] for row in sure if row[0].startswith(AGAIN)):
        # One that tells by standing once says no more by coming again.
        if len(again) < most and stem not in alone and not any(stem.startswith(x) or x.startswith(stem) for x in again):
            again.append(stem)
    return {x: i % MINED_VOTERS for i, x in enumerate(once)} | {AGAIN + x: i % AGAIN_VOTERS for i, x in enumerate(again)}


def _stem_rows(held: tuple[Counter[str], Counter[str]], seen: list[int]) -> pa.RecordBatch:
    # The empty beginning counts the rows.
    stems = ["", *(held[0].keys() | held[1].keys())]
    clean = [seen[0], *(held[0][x] for x in stems[1:])]
    toxic = [seen[1], *(held[1][x] for x in stems[1:])]
    return pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())], ["stem", "clean", "toxic"])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training: Column | None = None,
    rows_per_class: int = ROWS_PER_CLASS,
    free_rows: int = FREE_ROWS,
    most_stems: int = MINED_STEMS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """A model from labels where `training` (over the id) is true, and the votes on all texts of `docs`.

    Labels are 0 or 1; others and null are passed over, and of several for an id the highest counts. At most
    `rows_per_class` labelled ids of each class are used, those with the lowest hash, and `free_rows` others by their text
    alone: that bounds what is broadcast and what reaches the driver. The label model counts the vote patterns of every text. Without labels of both
    classes nothing is mined, and the lexicons alone say what the classes are.
    """
    id_name, label_name = fresh_name(docs.columns, "labelled_id"), fresh_name(docs.columns, "label")
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if training is not None:
        known = known.where(training)
    known = known.groupBy(F.col(id_col).alias(id_name)).agg(F.max(label_col).cast("int").alias(label_name))
    shares = {r[0]: r[1] for r in known.groupBy(label_name).count().collect()}
    prior = shares.get(1, 0) / sum(shares.values()) if len(shares) == 2 else 0.1
    parts = [lowest_hashes(known.where(F.col(label_name) == y), rows_per_class, id_name) for y in (0, 1)]
    chosen = parts[0].union(parts[1]).toArrow()
    if chosen.num_rows:
        # Rows whose label isn't used, whatever it is; an id that has several rows is drawn once.
        drawn = lowest_hashes(docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias(id_name)), free_rows, id_name).distinct().toArrow()
        free = drawn.filter(pc.invert(pc.is_in(drawn[id_name], chosen[id_name].combine_chunks())))
        free = free.append_column(label_name, pa.array([FREE] * free.num_rows, pa.int32()))
        sample = docs.sparkSession.createDataFrame(pa.concat_tables([chosen, free.cast(chosen.schema)]))
    else:
        sample = known.limit(0)
    learned = docs.join(F.broadcast(sample), docs[id_col] == sample[id_name]).select(
        F.col(text_col).alias("text"), F.col(label_name).alias("label")
    )
    stems = mined_stems(learned.where(F.col("label") != FREE), "text", "label", most_stems)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Votes(stems)
        counts: Counter[int] = Counter()
        for batch in slices(batches):
            counts.update(voters.of(x)[0] for x in text_column(batch, text_col))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["mask", "n"])

    # At most a row per pattern, of which the number of voters allows 2 ** 18.
    counted = docs.select(text_col).mapInArrow(patterns, "mask int, n long").groupBy("mask").agg(F.sum("n").alias("n")).toArrow()

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Votes(stems)
        for batch in slices(batches):
            masks, buckets = [], []
            for text in text_column(batch, "text"):
                bits, _, tokens = voters.of(text)
                masks.append(bits)
                # In an order of their own, so that sums don't depend on that of a set.
                buckets.append(np.sort(np.array([b for x in tokens for b in buckets_of(WORD.findall(x))], np.int32)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(masks, pa.int32()), batch.column("label"), pa.array(buckets, pa.binary())], ["mask", "label", "buckets"])

    rows = learned.mapInArrow(features, "mask int, label int, buckets binary").limit(2 * rows_per_class + free_rows).toArrow()
    masks, given = rows["mask"].to_numpy(), rows["label"].to_numpy()
    gold = masks[given != FREE], given[given != FREE]
    model = fit_label_model(counted["mask"].to_numpy(), counted["n"].to_numpy(), gold, prior)
    if not rows.num_rows:
        masks = counted["mask"].to_numpy()
        buckets, label_odds, weight = [b""] * counted.num_rows, 0.0, counted["n"].to_numpy()
    else:
        buckets = rows["buckets"].to_pylist()
        label_odds = np.select([given == 1, given == 0], [1, -1], 0) * np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
        own = [max((given == y).sum(), 1) for y in (1, 0, FREE)]
        weight = np.select([given == 1, given == 0], [prior / own[0], (1 - prior) / own[1]], FREE_WEIGHT / own[2])
    votes = vote_matrix(masks)
    target = posterior(model.log_odds(votes), label_odds)
    lengths = np.array([len(x) // 4 for x in buckets], np.int64)
    flat = np.frombuffer(b"".join(buckets), np.int32)
    bias, vote_weights, words = fit_linear(votes, lengths, flat, target, weight)
    return ToxicityModel(stems, bias, vote_weights, words.astype(np.float32), model)


def toxicity_score(model: Broadcast, text: Column) -> Column:
    """The score of a text, 0 to 1, higher where it is likelier toxic; a null text scores as an empty one."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model.value)
        for texts in batches:
            yield pd.Series([scorer.score(x or "") for x in texts], dtype="float64")
        release_memory()

    return score(text)


def toxicity(
    docs: DataFrame, labels: DataFrame, training: Column, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, score, predicted) for every row of `docs`; see fit_toxicity for what is learned.

    `training` is a condition on the id; where it isn't true, as for a null id, a row is held out. Ids, labels and
    other columns are no part of a score: equal texts score equally. A null text scores as an empty one. Repeated
    rows give repeated results, an empty table gives an empty result. A score says `predicted` from `threshold` on.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, training, id_col=id_col, text_col=text_col))
    scored = docs.select(
        F.col(id_col),
        (~F.coalesce(training, F.lit(False))).alias("held_out"),
        toxicity_score(model, F.col(text_col)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(
    docs: DataFrame, labels: DataFrame, training: Column | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that score below `threshold`, with all their columns; a null text is scored as an empty one."""
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, training, id_col=id_col, text_col=text_col))
    name = fresh_name(docs.columns, "score")
    return docs.withColumn(name, toxicity_score(model, F.col(text_col))).where(F.col(name) < threshold).drop(name)
