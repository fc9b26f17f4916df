"""Which files make up a table now: numbered manifests, of which the last whole one counts.

Tables are folders of files that are never changed. What they consist of stands in a manifest, a
small text file. A change writes its files first and then the next manifest, so readers see all of it
or nothing, and a change that fails on the way leaves the old manifest in force. Two writers cannot
write the same number; the later one starts again from the other's manifest.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from orderdw.sources.files import create_text, listed, read_text, remove

KEPT = 3  # manifests that stay, for readers that are just opening one
END = "\n"  # a manifest without it is still being written


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n) for n in listed(spark, folder) if n.isdigit())


def latest(spark: SparkSession, folder: str) -> tuple[int, Any]:
    """Number and content of the manifest in force; (0, None) where there is none."""
    numbers = _numbers(spark, folder)
    return max(numbers, default=0), _content(spark, folder, numbers)


def _content(spark: SparkSession, folder: str, numbers: list[int]) -> Any:
    for number in reversed(numbers):
        text = read_text(spark, f"{folder}/{number:012d}")
        if text.endswith(END):
            return json.loads(text)
    return None


def change(spark: SparkSession, folder: str, to: Callable[[Any], Any]) -> Any:
    """Put ``to(content in force)`` in force and return it. ``to`` is asked again if another writer
    comes first."""
    while True:
        numbers = _numbers(spark, folder)
        next_ = max(numbers, default=0) + 1
        new = to(_content(spark, folder, numbers))
        if create_text(spark, f"{folder}/{next_:012d}", json.dumps(new, sort_keys=True) + END):
            for old in numbers:
                if old <= next_ - KEPT:
                    remove(spark, f"{folder}/{old:012d}")
            return new
