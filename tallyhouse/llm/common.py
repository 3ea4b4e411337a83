"""What several operators share: words as the contracts define them, and batches as Python lists."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Words between white space: [^\x20\x09-\x0D]+.
SPACE = r"[\x20\x09-\x0D]+"
# Words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
NOT_LETTERS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_TABLE = bytes.maketrans(_UPPER.encode(), _LOWER.encode())
# Every byte of a letter word stays (other than ASCII is always a letter); the rest becomes a space.
LETTER_TABLE = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32
    for c in range(256)
)


def space_words(text: str | None) -> list[bytes]:
    """White-space words of a whole text as UTF-8; null has none."""
    return (text or "").encode("utf-8", "replace").split()


def letter_words(text: str | None) -> list[bytes]:
    """Lower-cased letter words of a whole text as UTF-8; null has none."""
    return (text or "").encode("utf-8", "replace").translate(LETTER_TABLE).split()


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def split_words(text: Column, separators: str) -> Column:
    """Words of a text column between ``separators``; null and empty texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), separators)
    return F.filter(parts, lambda w: w != F.lit(""))


def map_batches(
    df: DataFrame, work: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]], schema: T.StructType,
    rows: int | None = None,
) -> DataFrame:
    """``mapInArrow`` over plain columns: ``work`` gets and gives batches as dicts of lists or arrays.

    With ``rows`` it gets at most so many rows at once: Python values take several times their size in Arrow.
    """
    arrow = arrow_schema(schema)

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        step = rows or max(1, batch.num_rows)
        return (batch.slice(start, step) for start in range(0, max(1, batch.num_rows), step))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(part.to_pydict() for batch in batches for part in parts(batch)):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {
        T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(),
        T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64(), T.BinaryType(): pa.binary(),
        T.ArrayType(T.LongType()): pa.list_(pa.int64()), T.ArrayType(T.IntegerType()): pa.list_(pa.int32()),
        T.ArrayType(T.StringType()): pa.list_(pa.string()), T.ArrayType(T.DoubleType()): pa.list_(pa.float64()),
        T.ArrayType(T.BinaryType()): pa.list_(pa.binary()),
    }
    return pa.schema([pa.field(f.name, kinds[f.dataType]) for f in schema])


_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "double": T.DoubleType(), "binary": T.BinaryType(), "longs": T.ArrayType(T.LongType()),
    "ints": T.ArrayType(T.IntegerType()), "strings": T.ArrayType(T.StringType()), "doubles": T.ArrayType(T.DoubleType()),
    "binaries": T.ArrayType(T.BinaryType()),
}


def schema_of(columns: str) -> T.StructType:
    """``"name type, name type"``; needs no session, so tasks can call it too."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(","))])


def crc_mod(value: int, modulus: int) -> int:
    return zlib.crc32(str(value).encode()) % modulus
