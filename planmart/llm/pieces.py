"""Texts as pieces between white space, with each different piece looked at once a run.

Texts go in runs of about RUN_CHARS characters; a long text is cut before white
space into several parts, so one huge document never decides a task's memory.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_CHARS = 12 << 20
ROWS = 4096
SPACE = re.compile(r"[ \t\n\v\f\r]")


_SLOT: list[tuple[object, object]] = []


def of_worker(key: object, make: Callable[[], object]) -> object:
    """What `make` gives, kept by this Python worker from task to task until another key is asked
    for: a worker that serves one operator after the other remembers for one at a time."""
    if not _SLOT or _SLOT[0][0] != key:
        if _SLOT:
            _SLOT.clear()
            trim()
        _SLOT.append((key, make()))
    return _SLOT[0][1]


def forget() -> None:
    """Drop what this worker remembers: for functions that remember nothing themselves."""
    _SLOT.clear()


def trim() -> None:
    """Give freed memory back to the machine: workers that wait for later tasks share it with those that run."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):            # only the GNU library has this call
        ctypes.CDLL(None).malloc_trim(0)


def texts_of(column: pa.Array, size: int | None = None) -> Iterator[list[str | None]]:
    """A column as lists of about `size` bytes and ROWS texts at most, so that only a few are
    Python objects at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(column):
        held = int(ends[start - 1]) if start else 0
        end = int(np.searchsorted(ends, held + (size or RUN_CHARS), side="right"))
        end = min(max(end, start + 1), start + ROWS)
        yield strings(column.slice(start, end - start))
        start = end
    trim()


def slices_of(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """`batch` in slices whose `column` has about `size` bytes, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().tolist()
    start = held = 0
    for i, n in enumerate(lengths, 1):
        held += n
        if held >= size or i == len(lengths) or i - start >= ROWS:
            yield batch.slice(start, i - start)
            start, held = i, 0


def segments(text: str, size: int, spaces: re.Pattern = SPACE) -> Iterator[str]:
    """`text` in parts of about `size` characters, cut before white space; joined they are `text`."""
    start = 0
    while len(text) - start > size:
        cut = spaces.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def utf8_length(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def runs(texts: list[str | None], spaces: re.Pattern | None = SPACE, size: int | None = None,
         length: Callable[[str], int] = len) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers of the texts, their parts) of about `size` in `length` at a time: characters, or bytes
    with utf8_length; None and '' give no part."""
    size = size or RUN_CHARS
    owners: list[int] = []
    parts: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        for part in segments(text, max(1, size * len(text) // length(text)), spaces) if spaces else [text]:
            owners.append(i)
            parts.append(part)
            held += length(part)
            if held >= size:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


def strings(column: pa.Array) -> list[str | None]:
    """A column of strings as a list; quicker than `to_pylist`, which makes a scalar of each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def split(parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different pieces, for each piece its number among them, where each part's pieces begin and
    the last ends): pieces lie between ASCII white space; '' may be among them."""
    lists = pc.ascii_split_whitespace(pa.array(parts, pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy()
    return strings(coded.dictionary), coded.indices.to_numpy(), offsets - offsets[0]
