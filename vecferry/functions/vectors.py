"""Vector columns: norms, pairwise scores, packing. All but the half-float packing are built-ins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HALF_LIMIT = 65_520.0  # smallest magnitude that rounds to infinity as a half float


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(left: Column, right: Column) -> Column:
    return _total(F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")))


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def l2_distance(left: Column, right: Column) -> Column:
    def square(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_total(F.zip_with(left, right, square)))


def cosine(left: Column, right: Column) -> Column:
    return F.try_divide(dot(left, right), norm(left) * norm(right))


def normalize(vector: Column, digits: int = 6) -> Column:
    """Unit length, rounded. The norm is bound once, not worked out again for every element."""
    length = F.nullif(norm(vector), F.lit(0.0))
    scaled = F.transform(
        F.array(length), lambda n: F.transform(vector, lambda x: F.round(x.cast("double") / n, digits))
    )
    return scaled[0]


def bytes_to_floats(raw: Column) -> Column:
    """One float per unsigned byte."""
    size = F.octet_length(raw)
    positions = F.sequence(F.lit(1), F.greatest(size, F.lit(1)))
    floats = F.transform(positions, lambda i: F.conv(F.hex(F.substring(raw, i, F.lit(1))), 16, 10).cast("float"))
    return F.when(size == 0, F.array().cast("array<float>")).otherwise(floats)


def bytes_in_range(values: Column) -> Column:
    return F.forall(values, lambda x: F.coalesce(x.between(0, 255), F.lit(False)))


def pack_bytes(values: Column) -> Column:
    """Array of 0..255 to binary; null when an element is out of range."""
    text = F.array_join(F.transform(values, lambda x: F.lpad(F.hex(x.cast("long")), 2, "0")), "")
    return F.when(bytes_in_range(values), F.to_binary(text, F.lit("hex")))


def sign_bits(vector: Column, dim: int) -> Column:
    """One bit per dimension (set when positive), eight to a byte, first dimension highest; the last byte ends in zeros."""

    def byte(start: Column) -> Column:
        part = F.slice(vector, start * 8 + 1, 8)
        bits = F.aggregate(part, F.lit(0), lambda bits, x: bits * 2 + (x > 0).cast("int"))
        return bits * F.pow(F.lit(2), F.lit(8) - F.size(part)).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(-(-dim // 8) - 1)), byte)


def _half_floats(values: pa.Array) -> pa.Array:
    """Flattened once and converted once; each vector is a slice of the bytes."""
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(values).to_numpy(zero_copy_only=False).astype("<f2")
    ends = 2 * np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    missing = values.is_null().to_numpy(zero_copy_only=False)
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())])
    return pc.if_else(pa.array(missing), pa.scalar(None, pa.binary()), packed)


@F.arrow_udf(T.BinaryType())
def _pack_half(vectors: pa.Array) -> pa.Array:
    return _half_floats(vectors)


def pack_float16(vector: Column) -> Column:
    """Little-endian half floats, two bytes each."""
    return _pack_half(vector.cast("array<double>"))


def fits_float16(vector: Column) -> Column:
    return F.forall(vector, lambda x: F.coalesce(F.abs(x) < HALF_LIMIT, F.lit(False)))
