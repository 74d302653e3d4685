"""Words of texts as Arrow and numpy arrays, one batch at a time."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
SPACES = "\\x20\\x09-\\x0D"


class Words(NamedTuple):
    """The words of a batch: ``codes`` into ``values`` (distinct words), text i's from ``offsets[i]``."""

    codes: np.ndarray
    values: pa.Array
    offsets: np.ndarray


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


def split_words(texts: pa.Array) -> Words:
    """Split every text (null: none) into words and code them by their distinct values."""
    texts = pc.fill_null(plain(texts), "")
    lists = pc.ascii_split_whitespace(texts)
    flat = pc.list_flatten(lists)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # Blanks at either end leave empty pieces.
    filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not filled.all():
        owner = np.repeat(np.arange(len(lengths)), lengths)
        lengths = np.bincount(owner[filled], minlength=len(lengths)).astype(np.int64)
        flat = flat.filter(pa.array(filled))
    coded = plain(flat.dictionary_encode())
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return Words(codes, coded.dictionary, np.concatenate([[0], np.cumsum(lengths)]))


def word_hashes(values: pa.Array, seed: int) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(w, seed) for w in values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def buckets(values: pa.Array, size: int, seed: int) -> np.ndarray:
    """Each distinct word's bucket below ``size``, letters A-Z folded."""
    folded = pc.ascii_lower(values)
    return (word_hashes(folded, seed) % np.uint64(size)).astype(np.int64)


def batches_of(batch: pa.RecordBatch, text: str, most_bytes: int = 1 << 24):
    """Slices of a batch with at most ``most_bytes`` of text each, or a single row."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)
