"""A bounded memo of values computed for words, in two generations."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc


class Memo(dict):
    """Words to computed values; ``turn`` makes a full generation the old one, so memory stays bounded.

    Only time depends on the bound: a forgotten word is computed again.
    """

    def __init__(self, compute: Callable[[str], Any], limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, word: str) -> Any:
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        self[word] = value
        return value

    def turn(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


def by_size(sizes: Iterable[int], most: int) -> Iterable[range]:
    """Ranges of consecutive rows of about ``most`` bytes; a longer row stands alone."""
    start = total = i = 0
    for i, size in enumerate(sizes, 1):
        if i - 1 > start and total + size > most:
            yield range(start, i - 1)
            start, total = i - 1, 0
        total += size
    if start < i:
        yield range(start, i)


def parts(batch: pa.RecordBatch, text: int = 1, most: int = 8_000_000) -> Iterable[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    for rows in by_size(sizes, most):
        yield batch.slice(rows.start, len(rows))
