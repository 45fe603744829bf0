"""What the operators share: the word rule, table access, batches of bounded size, stable random numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_list(text: Column) -> Column:
    """Words of a text; none for NULL. The split leaves an empty first or last piece at most."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def unit_hash(*keys: Column | str, seed: str) -> Column:
    """A number in [0, 1) that depends on the keys and the seed only."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[_text(k) for k in keys])), 1, 12), 16, 10)
    return digits.cast("double") / F.lit(float(1 << 48))


def _text(key: Column | str) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(column.cast("string"), F.lit("\u0000"))


def list_parts(values: pa.Array, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cut a list<int64> array into runs of rows with about ``most`` elements: (elements as uint64, row starts).

    A NULL list is empty. A row longer than ``most`` is a run of its own.
    """
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
    ends = np.cumsum(lengths)
    row = done = 0
    while row < len(lengths):
        stop = max(row + 1, int(np.searchsorted(ends, done + most, "right")))
        starts = np.concatenate([[done], ends[row:stop]]) - done
        yield flat[done:ends[stop - 1]], starts
        row, done = stop, int(ends[stop - 1])


def text_parts(values: pa.Array, most_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cut a string array into runs of rows with about ``most_bytes`` each: (code points, row starts).

    A NULL text is empty. A longer text is a run of its own.
    """
    whole = pc.fill_null(values.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(whole).to_numpy(zero_copy_only=False))
    row = done = 0
    while row < len(whole):
        stop = max(row + 1, int(np.searchsorted(ends, done + most_bytes, "right")))
        rows = whole.slice(row, stop - row)
        codes = np.frombuffer("".join(rows.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.concatenate([[0], np.cumsum(pc.utf8_length(rows).to_numpy(zero_copy_only=False))])
        yield codes, starts.astype(np.int64)
        row, done = stop, int(ends[stop - 1])


def byte_parts(values: pa.Array, most_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string or binary array into runs of rows with about ``most_bytes`` each: (first row, next row, bytes, row starts).

    The bytes are a view of the array's own memory. A NULL text is empty; a longer text is a run of its own.
    """
    whole = pc.fill_null(values.cast(pa.large_binary()), b"")
    if not len(whole):
        return
    _, places, data = whole.buffers()
    ends = np.frombuffer(places, np.int64)[whole.offset:whole.offset + len(whole) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < len(whole):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + most_bytes, "right")) - 1)
        yield row, stop, flat[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row]
        row = stop


def cut_words(table: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of concatenated texts as one string array, their rows and the place of their first byte.

    ``table`` maps a byte to the byte that a word keeps of it, 0 where no word has it. No word crosses two rows.
    """
    bytes_kept = table[flat]
    inside = bytes_kept != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = starts[1:-1][starts[1:-1] < len(flat)]
    first[edges] = inside[edges]
    places = np.flatnonzero(first)
    offsets = np.concatenate([np.cumsum(inside, dtype=np.int64)[places] - 1, [np.count_nonzero(inside)]])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(bytes_kept[inside])],
    )
    return words, np.searchsorted(starts, places, "right") - 1, places
