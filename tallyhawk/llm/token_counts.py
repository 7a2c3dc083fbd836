"""Token counts of whole texts by a public tokenizer, without the ids."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhawk.llm.common import byte_balanced, slices, text_column
from tallyhawk.llm.tokenizer_pool import load_tokenizer

#: White space beside which a cut could change the tokens: anything but single blanks and line ends
#: between other characters.
UNSAFE = re.compile(r"\A\s|\s\Z|\s\s|[^\S \n]")
#: The cut that is safe in any text: before a single blank between two other characters.
SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Chunks kept in a worker's memory, and the longest that is kept.
MEMO_CHUNKS, MEMO_CHARS = 300_000, 40


class Lengths:
    """Token counts of chunks that a byte-level pre-tokenizer never joins.

    Such a tokenizer takes one blank into the word that follows it, so a text may be cut before a single
    blank, and on both sides of a single line end, and the counts of the parts add up. Most chunks are
    words seen before; only new ones reach the tokenizer, in batches balanced by bytes.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.known: dict[str, int] = {"": 0}
        self.line_end = self._encode(["\n"])[0]

    def _encode(self, chunks: list[str]) -> list[int]:
        lengths: list[int] = []
        for start, end in byte_balanced(chunks, 1 << 20):
            encoded = self.tokenizer.encode_batch_fast(chunks[start:end], add_special_tokens=False)
            lengths += [len(x) for x in encoded]
        return lengths

    def counts(self, texts: list[str]) -> list[int]:
        """Token counts of `texts`; every text is looked at whole."""
        known = self.known if len(self.known) < MEMO_CHUNKS else {"": 0}
        cut = [chunks(x) for x in texts]
        new = list(set(chain.from_iterable(x for x, _ in cut)) - known.keys())
        known.update(zip(new, self._encode(new), strict=True))
        totals = [line_ends * self.line_end + sum(map(known.__getitem__, pieces)) for pieces, line_ends in cut]
        for chunk in new:
            if len(chunk) > MEMO_CHARS:
                del known[chunk]
        self.known = known
        return totals


def chunks(text: str) -> tuple[list[str], int]:
    """Parts of a text that are encoded apart, and the number of single line ends between them."""
    if UNSAFE.search(text):
        return SAFE_CUT.split(text), 0
    # After the replacement each blank starts a chunk; a line end stands alone between two chunks.
    lines = text.split("\n")
    if len(lines) == 1:
        return text.replace(" ", "\n ").split("\n"), 0
    return list(chain.from_iterable(x.replace(" ", "\n ").split("\n") for x in lines)), len(lines) - 1


@cache
def _lengths(path: str) -> Lengths:
    """One per worker process and tokenizer file, so that chunks stay known from task to task."""
    return Lengths(path)


def token_counts(
    df: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of `df`, as the library counts whole texts.

    The file must be one of the `tokenizers` library with byte-level pre-tokenization; its path must be
    readable on every executor. A null text counts as empty: no bytes, no tokens. Repeated ids give
    repeated rows, a null id stays null, an empty table gives an empty result; other columns are not
    read. Nothing is shuffled: each input split is counted where it is read.
    """
    id_field = df.schema[id_col]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(tokenizer_path)
        for batch in slices(batches):
            texts = text_column(batch, text_col)
            tokens: list[int] = []
            for start, end in byte_balanced(texts):
                tokens += lengths.counts(texts[start:end])
            sizes = [len(x.encode()) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = T.StructType(
        [
            T.StructField(id_col, id_field.dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    return df.select(id_col, text_col).mapInArrow(count, schema)
