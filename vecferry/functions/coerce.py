"""Column expressions that turn a source value into its declared target type.

The choice of expression is made once, from the column types, while the plan is built. Every
expression is null where the value cannot be converted, and comes with the reason for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.functions import vectors

INTEGERS = {"INT8": "tinyint", "INT16": "smallint", "INT32": "int", "INT64": "bigint"}
FLOATS = {"FLOAT": "float", "DOUBLE": "double"}
ELEMENTS = {"VARCHAR": "string", **INTEGERS, **FLOATS, "BOOL": "boolean"}
VECTORS = ("FLOAT_VECTOR", "FLOAT16_VECTOR", "BINARY_VECTOR")
BOUNDS = {kind: (-(1 << bits - 1), (1 << bits - 1) - 1) for kind, bits in (
    ("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64))}
BLANKS = " \t\n\x0b\x0c\r"
INTEGER_TEXT = r"^[+-]?[0-9]+$"
NUMBER_TEXT = r"^(?i)[+-]?([0-9]+\.?[0-9]*([e][+-]?[0-9]+)?|\.[0-9]+([e][+-]?[0-9]+)?|inf|infinity|nan)$"


@dataclass(frozen=True)
class FieldSpec:
    source: str
    target: str
    target_type: str
    element_type: str | None = None
    max_length: int | None = None
    max_capacity: int | None = None
    dim: int | None = None
    is_key: bool = False
    is_partition_key: bool = False
    nullable: bool = False
    wrap_text: bool = False  # JSON as the fallback of an unknown type: text that is no JSON becomes {"value": ...}
    index_type: str | None = None  # of a vector field
    metric_type: str | None = None

    @property
    def is_vector(self) -> bool:
        return self.target_type in VECTORS


def iso_text(column: Column, source_type: T.DataType) -> Column:
    """Fixed-width ISO-8601 text in UTC, so text order is time order, whatever the session's time zone."""
    if isinstance(source_type, T.TimestampType):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        column = F.timestamp_add("MICROSECOND", F.unix_micros(column), epoch)
    plain = column.cast("string")
    fraction = F.rpad(F.substring(plain, 21, 6), 6, "0")
    return F.concat(F.substring(plain, 1, 10), F.lit("T"), F.substring(plain, 12, 8), F.lit("."), fraction, F.lit("Z"))


def as_json(column: Column) -> Column:
    return F.to_json(column, {"ignoreNullFields": "false"})


def _nested(source_type: T.DataType) -> bool:
    return isinstance(source_type, (T.StructType, T.MapType, T.ArrayType))


def to_varchar(column: Column, source_type: T.DataType, max_length: int | None = None) -> Column:
    if isinstance(source_type, T.StringType):
        return column if max_length is None else F.substring(column, 1, max_length)
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(column, source_type)
    return as_json(column) if _nested(source_type) else column.cast("string")


def to_bool(column: Column, source_type: T.DataType) -> Column:
    """Truthiness: any non-empty text (also 'false'), any non-zero number, any non-empty list."""
    if isinstance(source_type, T.BooleanType):
        return column
    if isinstance(source_type, (T.StringType, T.BinaryType)):
        return F.octet_length(column) > 0
    if isinstance(source_type, (T.ArrayType, T.MapType)):
        return F.size(column) > 0
    if isinstance(source_type, T.NumericType):
        return column != 0
    return column.isNotNull()


def to_json_text(column: Column, source_type: T.DataType, wrap_text: bool = False) -> Column:
    if _nested(source_type):
        return as_json(column)
    wrapped = as_json(F.struct(column.alias("value")))
    if isinstance(source_type, T.StringType):
        checked = F.when(F.try_parse_json(column).isNotNull(), column)
        return F.when(column.isNotNull(), F.coalesce(checked, wrapped)) if wrap_text else checked
    return wrapped


def _always_fits(source_type: T.DataType, target: str) -> bool:
    if isinstance(source_type, T.BooleanType):
        return True
    if target not in BOUNDS:
        return isinstance(source_type, T.NumericType)
    return isinstance(source_type, T.IntegralType) and BOUNDS[source_type.simpleString()][1] <= BOUNDS[target][1]


def can_fail(source_type: T.DataType, spec: FieldSpec) -> bool:
    """Whether a present value may turn out not to convert; other fields need no check per row."""
    target = spec.target_type
    if target in INTEGERS or target in FLOATS:
        return not _always_fits(source_type, {**INTEGERS, **FLOATS}[target])
    if target == "JSON":
        return isinstance(source_type, T.StringType) and not spec.wrap_text
    if target == "ARRAY":
        return (spec.element_type or "VARCHAR") != "VARCHAR"
    return spec.is_vector and not isinstance(source_type, T.BinaryType)


def to_number(column: Column, source_type: T.DataType, target: str) -> Column:
    """Cast that is null where the value does not fit; fractions are cut off.

    Bad text and wide numbers are sorted out first: a cast that fails and is caught costs far more
    than a comparison.
    """
    if isinstance(source_type, T.StringType):
        return F.when(F.btrim(column, F.lit(BLANKS)).rlike(INTEGER_TEXT if target in BOUNDS else NUMBER_TEXT), F.btrim(column, F.lit(BLANKS)).try_cast(target))
    if _always_fits(source_type, target):
        return column.cast(target)
    if target not in BOUNDS or not isinstance(source_type, (T.FractionalType, T.IntegralType)):
        return column.try_cast(target)
    low, high = BOUNDS[target]
    if isinstance(source_type, T.IntegralType):
        fits = column.between(low, high)
    elif target == "bigint":
        fits = (column >= float(low)) & (column < float(high))
    else:
        fits = (column > low - 1) & (column < high + 1)
    return F.when(fits, column.cast(target))


def to_array(column: Column, source_type: T.DataType, element_type: str | None) -> Column:
    """Elementwise cast; a bad number makes the whole value null, a null text element stays."""
    element = ELEMENTS.get(element_type or "VARCHAR", "string")
    if not isinstance(source_type, T.ArrayType):
        single = column.cast("string") if element == "string" else to_number(column, source_type, element)
        return F.when(single.isNotNull(), F.array(single))
    if element == "string":
        return F.transform(column, lambda x: to_varchar(x, source_type.elementType))
    values = F.transform(column, lambda x: to_number(x, source_type.elementType, element))
    return F.when(F.forall(values, lambda x: x.isNotNull()), values)


def to_vector(column: Column, source_type: T.DataType, target_type: str) -> Column:
    is_bytes = isinstance(source_type, T.BinaryType)
    if target_type == "FLOAT_VECTOR":
        if is_bytes:
            return vectors.bytes_to_floats(column)
        complete = F.forall(column, lambda x: x.isNotNull())
        return F.when(complete, column.try_cast("array<float>"))
    if is_bytes:
        return column
    if target_type == "FLOAT16_VECTOR":
        return F.when(vectors.fits_float16(column), vectors.pack_float16(column))
    return vectors.pack_bytes(column)


def convert(column: Column, source_type: T.DataType, spec: FieldSpec) -> Column:
    """Value of one field in its target type; null if the source is null or cannot be converted."""
    if isinstance(source_type, T.NullType):
        return F.lit(None).cast(spark_type(spec))
    target = spec.target_type
    if target == "VARCHAR":
        return to_varchar(column, source_type, spec.max_length)
    if target in INTEGERS or target in FLOATS:
        return to_number(column, source_type, {**INTEGERS, **FLOATS}[target])
    if target == "BOOL":
        return to_bool(column, source_type)
    if target == "JSON":
        return to_json_text(column, source_type, spec.wrap_text)
    if target == "ARRAY":
        return to_array(column, source_type, spec.element_type)
    return to_vector(column, source_type, target)


def spark_type(spec: FieldSpec) -> T.DataType:
    simple = {
        "VARCHAR": T.StringType(), "JSON": T.StringType(), "BOOL": T.BooleanType(), "INT8": T.ByteType(),
        "INT16": T.ShortType(), "INT32": T.IntegerType(), "INT64": T.LongType(), "FLOAT": T.FloatType(),
        "DOUBLE": T.DoubleType(), "FLOAT_VECTOR": T.ArrayType(T.FloatType()),
        "FLOAT16_VECTOR": T.BinaryType(), "BINARY_VECTOR": T.BinaryType(),
    }
    if spec.target_type != "ARRAY":
        return simple[spec.target_type]
    return T.ArrayType(simple.get(spec.element_type or "VARCHAR", T.StringType()))


def default_value(spec: FieldSpec) -> Column | None:
    """What a missing value becomes; vectors have no default."""
    if spec.is_vector:
        return None
    if spec.target_type == "ARRAY":
        return F.array().cast(spark_type(spec))
    plain = {"VARCHAR": "", "JSON": "{}", "BOOL": False}
    return F.lit(plain.get(spec.target_type, 0)).cast(spark_type(spec))
