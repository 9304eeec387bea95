"""Batches of texts as numpy arrays, for the operators that run in Arrow functions."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text handled at a time (one document more at most).
SLICE_BYTES = 2 * 1024 * 1024


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of ``column``, no row cut."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(size)
    if start < len(sizes):
        yield batch.slice(start)


def filled(column: pa.Array) -> pa.Array:
    """Texts with NULL as '', in an array of its own with offsets from 0."""
    return pa.concat_arrays([pc.fill_null(column, "")]) if column.null_count else pa.concat_arrays([column])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins (one more place than texts)."""
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[places[0] : places[-1]], (places - places[0]).astype(np.int64)


def sums(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Per text the sum of what lies between its places."""
    running = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return running[places[1:]] - running[places[:-1]]


def lists(column: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The flat values of a list array and where each list begins."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def owners(places: np.ndarray) -> np.ndarray:
    """For each value the number of the list that holds it."""
    return np.repeat(np.arange(len(places) - 1), np.diff(places))


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat words (runs without ASCII white space) and where each text's begin."""
    flat, places = lists(pc.ascii_split_whitespace(texts))
    held = pc.greater(pc.binary_length(flat), 0)
    if pc.all(held).as_py() is False:
        counts = sums(held.to_numpy(zero_copy_only=False), places)
        flat, places = flat.filter(held), np.concatenate([[0], np.cumsum(counts)])
    return flat, places


def codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Small numbers for equal values, and the distinct values by number."""
    encoded = values.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def mixed(values: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits (a bijection)."""
    x = values.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
