"""Best-fit decreasing packing of tokenized documents into fixed windows."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from tallyhawk.llm.common import byte_balanced, slices, text_column
from tallyhawk.llm.tokenizer_pool import load_tokenizer

WINDOW = 2048
END_ID = 1
#: Tokens that a task packs together; bounds its memory and is far above what good packing needs.
POOL_TOKENS = 2_000_000
#: The smallest hole that is worth a cut.
LEAST_FRAGMENT = 16
#: Parts of words kept in a worker's memory, and the longest that is kept.
MEMO_WORDS, MEMO_CHARS = 400_000, 40
#: New parts that the tokenizer gets in one string.
JOINED_WORDS = 100
#: What may end a plain word, the letters before it, and both in Arrow's syntax: such a word is two pieces to a tokenizer of SPLITTING.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
PLAIN = rf"^(?P<letters>{LETTERS.pattern})(?P<end>[[:punct:]]*)$"
#: How a tokenizer normalizes and splits that takes plain words apart so: case is lost, letters end where punctuation begins.
SPLITTING = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}

PIECES = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("padded_length", T.LongType()),
    ]
)


class KnownWords(dict):
    """Ids of parts of words in two generations: what is looked up stays, what isn't goes with the older one.

    A part that neither knows is noted in `unknown` and has None for ids until they are set.
    """

    def __init__(self) -> None:
        super().__init__({"": b""})
        self.older: dict[str, bytes] = {}
        self.unknown: set[str] = set()

    def __missing__(self, word: str) -> bytes | None:
        ids = self.older.get(word)
        if ids is None:
            self.unknown.add(word)
        self[word] = ids
        return ids

    def age(self) -> None:
        """Begin a new generation where this one is full; together they hold MEMO_WORDS and a batch's."""
        if len(self) > MEMO_WORDS // 2:
            self.older = dict(self)
            self.clear()
            self[""] = b""


class LowerWords:
    """Ids of lower-case words of LETTERS by the model of a tokenizer of SPLITTING, which leaves them as they are."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = Tokenizer(tokenizer.model)
        split = pre_tokenizers.Split(" ", "removed")
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary, suffix = tokenizer.get_vocab(), tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    @staticmethod
    def fits(tokenizer: Tokenizer) -> bool:
        """Whether the tokenizer is of SPLITTING, marks ends of words, and has no added token inside plain words."""
        settings = json.loads(tokenizer.to_str())
        added = (x["content"].rstrip(PUNCTUATION) for x in settings["added_tokens"])
        model = settings["model"]
        return (
            all(settings[k] == v for k, v in SPLITTING.items())
            and model["type"] == "BPE"
            and bool(model["end_of_word_suffix"])
            and not any(not x or LETTERS.fullmatch(x) for x in added)
        )

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Words are told apart by the tokens that end one; what this can't tell apart is left out."""
        found: dict[str, bytes] = {}
        parts = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        for start, end in byte_balanced([" ".join(x) for x in parts], 1 << 20):
            encoded = self.tokenizer.encode_batch_fast([" ".join(x) for x in parts[start:end]], add_special_tokens=False)
            for own, e in zip(parts[start:end], encoded, strict=True):
                ids = np.array(e.ids, "<u4")
                cuts = [0, *(4 * np.flatnonzero(self.ends[ids]) + 4).tolist()]
                if len(cuts) == len(own) + 1:
                    data = ids.tobytes()
                    found.update(zip(own, [data[i:j] for i, j in zip(cuts, cuts[1:], strict=False)], strict=True))
        return found


class WordIds:
    """Ids of texts by a tokenizer that drops white space, so that the ids of words join to those of the text.

    Texts are cut at blanks and line ends only, plain words also where their letters end. Arrow cuts them and
    tells their words apart, so that Python sees each part once a batch. Ids are little-endian unsigned 32-bit bytes.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.lower = LowerWords(self.tokenizer) if LowerWords.fits(self.tokenizer) else None
        self.known = KnownWords()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        words = pc.split_pattern(pa.array([x.replace("\n", " ") for x in texts], pa.string()), " ")
        each = words.flatten().dictionary_encode()
        ids = self._words(each.dictionary).take(each.indices)
        self.known.age()
        return pc.binary_join(pa.ListArray.from_arrays(words.offsets, ids), pa.scalar(b"", ids.type)).to_pylist()

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of words: of plain ones those of their letters in lower case and those of the punctuation behind."""
        if self.lower is None:
            return self._parts(words)
        plain = pc.extract_regex(words, PLAIN)
        # Lower-case letters are as many as before.
        letters = self._parts(pc.coalesce(pc.utf8_lower(pc.struct_field(plain, "letters")), words))
        ends = self._parts(pc.coalesce(pc.struct_field(plain, "end"), ""))
        return pc.binary_join_element_wise(letters, ends, pa.scalar(b"", letters.type))

    def _parts(self, parts: pa.Array) -> pa.Array:
        """Ids of words, letters or punctuation, none of which holds a blank, from memory where they are known."""
        known, each = self.known, parts.dictionary_encode()
        # Joined and split, strings leave Arrow several times faster than one by one.
        parts = pc.binary_join(pa.ListArray.from_arrays([0, len(each.dictionary)], each.dictionary), " ")[0].as_py().split(" ")
        ids = list(map(known.__getitem__, parts))
        if known.unknown:
            fresh = self._fresh(known.unknown)
            ids = [fresh[part] if x is None else x for x, part in zip(ids, parts, strict=True)]
            known.update(fresh)
            for long in [x for x in fresh if len(x) > MEMO_CHARS]:
                del known[long]
            known.unknown.clear()
        return pa.array(ids, pa.large_binary()).take(each.indices)

    def _fresh(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of parts: of lower-case letters from the model, of all others from the whole tokenizer."""
        found = {} if self.lower is None else self.lower.encode([x for x in parts if LETTERS.fullmatch(x)])
        return found | self._encode([x for x in parts if x not in found])

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words: many at a time, parted by a blank, their ids told apart by where they begin."""
        parts = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        found: dict[str, bytes] = {}
        for start, end in byte_balanced([" ".join(x) for x in parts], 1 << 20):
            encoded = self.tokenizer.encode_batch([" ".join(x) for x in parts[start:end]], add_special_tokens=False)
            for own, e in zip(parts[start:end], encoded, strict=True):
                ids = np.array(e.ids, "<u4")
                begins = np.cumsum([0, *(len(w) + 1 for w in own)])
                cuts = (4 * np.searchsorted(np.array([x for x, _ in e.offsets], np.int64), begins)).tolist()
                data = ids.tobytes()
                found.update((w, data[i:j]) for w, i, j in zip(own, cuts, cuts[1:], strict=False))
        return found


class CapacityTree:
    """Open windows by remaining capacity: a segment tree over 0..window that counts windows per capacity."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.counts = [0] * (2 * self.size)
        self.windows: dict[int, list[int]] = {}

    def add(self, capacity: int, window: int) -> None:
        self.windows.setdefault(capacity, []).append(window)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.counts[node] += by
            node >>= 1

    def tightest(self, least: int) -> int:
        """The smallest capacity of at least `least` that an open window has, or -1."""
        counts, node = self.counts, least + self.size
        if counts[node]:
            return least
        while node > 1:  # up to the first right sibling that holds a window, then down its left edge
            if not node & 1 and counts[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if counts[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return -1

    def take(self, capacity: int) -> int:
        self._change(capacity, -1)
        return self.windows[capacity].pop()


@dataclass
class Sequence:
    #: (document's index, start in the document, length)
    pieces: list[tuple[int, int, int]] = field(default_factory=list)
    fill: int = 0

    def add(self, piece: tuple[int, int, int]) -> None:
        self.pieces.append(piece)
        self.fill += piece[2]

    def take(self, most: int) -> tuple[int, int, int]:
        """Up to `most` tokens from the end of the last piece."""
        doc, start, length = self.pieces.pop()
        cut = min(most, length)
        if cut < length:
            self.pieces.append((doc, start, length - cut))
        self.fill -= cut
        return doc, start + length - cut, cut


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[Sequence]:
    """Sequences that hold every token of documents of the given lengths once.

    Overlong documents are cut into full windows first. What is left goes, longest first, into the open
    window that it fills best. Holes of LEAST_FRAGMENT tokens or more are then filled with pieces cut from
    the emptiest windows, and the one window that stays partly empty becomes windows whose lengths are
    powers of two, which need no padding.
    """
    full, rest = [], []
    for doc, length in enumerate(lengths):
        whole = length - length % window
        full += [Sequence([(doc, start, window)], window) for start in range(0, whole, window)]
        if length > whole:
            rest.append((doc, whole, length - whole))
    rest.sort(key=lambda x: -x[2])
    tree, packed = CapacityTree(window), []
    for piece in rest:
        capacity = tree.tightest(piece[2])
        if capacity < 0:
            packed.append(Sequence())
            index, capacity = len(packed) - 1, window
        else:
            index = tree.take(capacity)
        packed[index].add(piece)
        if capacity > piece[2]:
            tree.add(capacity - piece[2], index)
    return full + _fill_holes(packed, window)


def _fill_holes(packed: list[Sequence], window: int) -> list[Sequence]:
    packed.sort(key=lambda x: -x.fill)
    taker, donor = 0, len(packed) - 1
    while taker < donor:
        hole = window - packed[taker].fill
        if hole < LEAST_FRAGMENT:
            taker += 1
            continue
        packed[taker].add(packed[donor].take(hole))
        if not packed[donor].fill:
            packed.pop()
            donor -= 1
    if packed and LEAST_FRAGMENT <= window - packed[-1].fill:
        last = packed.pop()
        while last.fill:
            part, want = Sequence(), 1 << (last.fill.bit_length() - 1)
            while part.fill < want:
                part.add(last.take(want - part.fill))
            packed.append(part)
    return packed


def padded_length(fill: int, window: int = WINDOW) -> int:
    return fill if fill & (fill - 1) == 0 else window


@cache
def _word_ids(path: str) -> WordIds:
    """One per worker process and tokenizer file, so that words stay known from task to task."""
    return WordIds(path)


def pack(
    df: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    pool_tokens: int = POOL_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of at most `window` tokens, as (id, *PIECES).

    A document's tokens are its ids by the tokenizer and `end_id`; a null or empty text is `end_id` alone.
    The tokenizer must drop white space. Every split packs its own documents, in pools of about
    `pool_tokens`, so nothing is shuffled; a pool leaves holes of fewer than LEAST_FRAGMENT tokens only.
    Sequence ids come from the number of the split: stored input gives a repeated task the same ids.
    Repeated rows are packed once each; with equal ids their pieces can't be told apart. A null id stays
    null, an empty table gives no pieces, other columns are not read.
    """
    id_field = T.StructField(id_col, df.schema[id_col].dataType)
    schema = T.StructType([id_field, *PIECES.fields])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer_path)
        next_id = TaskContext.get().partitionId() << 33
        keys: list[pa.Array] = []
        docs: list[bytes] = []
        pooled = 0
        for batch in slices(batches):
            texts = text_column(batch, text_col)
            for first, last in byte_balanced(texts):
                ids = [x + end for x in words.encode(texts[first:last])]
                docs += ids
                keys.append(batch.column(id_col).slice(first, last - first))
                pooled += sum(map(len, ids)) // 4
                if pooled >= pool_tokens:
                    rows, next_id = _rows(keys, docs, next_id, window, schema)
                    yield from rows
                    keys, docs, pooled = [], [], 0
        if docs:
            rows, next_id = _rows(keys, docs, next_id, window, schema)
            yield from rows

    return df.select(id_col, text_col).mapInArrow(run, schema)


def _rows(
    keys: list[pa.Array], docs: list[bytes], next_id: int, window: int, schema: T.StructType
) -> tuple[list[pa.RecordBatch], int]:
    columns: list[list[int]] = [[] for _ in range(1 + len(PIECES))]
    for sequence in best_fit_decreasing([len(x) // 4 for x in docs], window):
        offset, padded = 0, padded_length(sequence.fill, window)
        for doc, start, length in sequence.pieces:
            ids = docs[doc]
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
            for column, value in zip(columns, (doc, start, length, crc, len(ids) // 4, next_id, offset, padded), strict=True):
                column.append(value)
            offset += length
        next_id += 1
    ids = pa.concat_arrays(keys).take(pa.array(columns[0], pa.int64()))
    whole = pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in columns[1:])], schema.names)
    return [whole.slice(i, 50_000) for i in range(0, whole.num_rows, 50_000)], next_id
