"""What a run has finished, so that the next try of the same run goes on from there."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import date
from decimal import Decimal
from typing import Any

from pyspark.sql import SparkSession

from tallyhawk.sources import storage


class Journal:
    """Steps of one run of one date: a small file for each finished one, that holds its result.

    ``inputs`` says what the run works on; a journal of other inputs is dropped, since nothing of it may be used.
    A file is put in place by a rename, so that a step is either recorded whole or not at all. Steps must leave
    the same state when they run again: one that died before its record does.
    """

    def __init__(self, spark: SparkSession, root: str, day: date, inputs: Any):
        self.spark = spark
        self.folder = f"{root}/day={day.isoformat()}"
        self.resumed: list[str] = []
        self.inputs = hashlib.sha256(json.dumps(inputs, sort_keys=True, default=str).encode()).hexdigest()
        if storage.read_text(spark, f"{self.folder}/inputs") != self.inputs:
            storage.delete(spark, self.folder)
            storage.write_text(spark, f"{self.folder}/inputs", self.inputs)

    def step(self, name: str, work: Callable[[], Any]) -> Any:
        """The result of ``work``: done now and recorded, or as it was recorded by an earlier try."""
        path = f"{self.folder}/{name}.json"
        known = storage.read_text(self.spark, path)
        if known is not None:
            self.resumed.append(name)
            return json.loads(known, object_hook=_from_json)
        result = work()
        text = json.dumps(result, default=_to_json)
        storage.write_text(self.spark, path, text)
        # What the caller gets does not depend on which try it is.
        return json.loads(text, object_hook=_from_json)

    def close(self) -> None:
        """The run is whole: the next one of this date begins anew."""
        storage.delete(self.spark, self.folder)


def _to_json(value: Any) -> Any:
    if isinstance(value, Decimal):
        return {"decimal": str(value)}
    raise TypeError(f"a step returned {type(value).__name__}")


def _from_json(value: dict) -> Any:
    return Decimal(value["decimal"]) if value.keys() == {"decimal"} else value
