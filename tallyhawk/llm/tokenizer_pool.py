"""Tokenizers of a worker process."""

from __future__ import annotations

import os
from functools import cache

from tokenizers import Tokenizer


@cache
def load_tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a .json file, without truncation or padding; one thread, as Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer
