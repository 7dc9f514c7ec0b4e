"""Words of Arrow text columns as hashes, a piece of a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Texts are taken in pieces of about so many bytes, so that a task's arrays stay small; one text is never cut.
PIECE_BYTES = 4 << 20
U = np.uint64
_MIX1, _MIX2 = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal numbers stay equal, others scatter."""
    x = (x ^ (x >> U(33))) * _MIX1
    x = (x ^ (x >> U(33))) * _MIX2
    return x ^ (x >> U(33))


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about PIECE_BYTES of text, or one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PIECE_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def hashed_words(lowered: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(hashes, counts, codes, dictionary): 64-bit hashes of all words, their number in each text, and which of the distinct words they are.

    Words are runs without 20 and 09 to 0D. A null text has none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(lowered, ""))
    coded = lists.flatten().dictionary_encode()
    known = coded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in known], U)
    offsets = np.asarray(lists.offsets)
    offsets = offsets - offsets[0]
    codes = np.asarray(coded.indices)
    kept = codes != (known.index("") if "" in known else -1)
    before = np.concatenate(([0], np.cumsum(kept)))
    codes = codes[kept]
    return hashes[codes], np.diff(before[offsets]), codes, known


def long_lists(values: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit numbers as an Arrow list column."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
