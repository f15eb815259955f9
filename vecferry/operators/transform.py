"""Documents to typed rows: one projection, no per-row Python, bad rows kept aside with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.functions import variants
from vecferry.functions.coerce import FieldSpec, can_fail, convert, default_value, spark_type
from vecferry.operators.checks import stored_size

REASON = "_reject_reason"
GENERATED_KEY = "_generated_id"


def field_specs(
    conversions: DataFrame, index_name: str, max_fields: int = 10_000, resolved: DataFrame | None = None
) -> list[FieldSpec]:
    """The kept fields of one index, in declared order.

    The plan of a load has an expression per field, so they are read to the driver; ``max_fields`` guards it against a
    catalog that is not one, and an index that declares more fails loudly unless the caller allows them. ``resolved``,
    from ``resolve_profiles``, adds index type and metric of the vector fields.
    """
    indexes = {}
    if resolved is not None:
        of_index = resolved.filter(F.col("index_name") == index_name).select("field_name", "index_type", "metric_type")
        found = of_index.limit(max_fields + 1).collect()
        if len(found) > max_fields:
            raise ValueError(f"index {index_name} declares more than {max_fields} vector fields")
        indexes = {r.field_name: (r.index_type, r.metric_type) for r in found}
    rows = (
        conversions.filter((F.col("index_name") == index_name) & ~F.col("skipped"))
        .select("ordinal", "field_name", "target_name", "target_type", "element_type", "max_length",
                "max_capacity", "dim", "is_primary_key", "is_partition_key", "confidence")
        .limit(max_fields + 1).collect()
    )
    if len(rows) > max_fields:
        raise ValueError(f"index {index_name} declares more than {max_fields} fields")
    return [
        FieldSpec(
            r.field_name, r.target_name, r.target_type, r.element_type, r.max_length, r.max_capacity,
            r.dim, r.is_primary_key, r.is_partition_key, wrap_text=r.confidence == "unsupported",
            index_type=indexes.get(r.field_name, (None, None))[0], metric_type=indexes.get(r.field_name, (None, None))[1],
        )
        for r in sorted(rows, key=lambda r: r.ordinal)
    ]


def target_schema(specs: list[FieldSpec]) -> T.StructType:
    """Columns of the target table; limits and roles travel as column metadata."""
    roles = {
        "max_length": "max_length", "max_capacity": "max_capacity", "dim": "dim", "is_key": "primary_key",
        "is_partition_key": "partition_key", "index_type": "index_type", "metric_type": "metric_type",
    }
    return T.StructType([
        T.StructField(
            s.target, spark_type(s), True,
            {"target_type": s.target_type, **{n: getattr(s, a) for a, n in roles.items() if getattr(s, a)}},
        )
        for s in specs
    ])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def strip_metadata(documents: DataFrame) -> DataFrame:
    """Columns that start with ``@`` belong to the search response, not to the document."""
    return documents.select(*[_quoted(c) for c in documents.columns if not c.startswith("@")])


def dynamic_fields(documents: DataFrame, specs: list[FieldSpec], as_variant: bool = False) -> Column:
    """Undeclared fields as one JSON value, or as a Variant that keeps their types."""
    declared = {s.source for s in specs}
    rest = [F.col(_quoted(c)) for c in documents.columns if c not in declared and not c.startswith("@")]
    if as_variant:
        return variants.packed(*rest) if rest else F.parse_json(F.lit("{}"))
    return F.to_json(F.struct(*rest)) if rest else F.lit("{}")


def generated_key(documents: DataFrame) -> Column:
    """A key for documents of an index without one: a digest of the whole row, the same in every run.

    Documents that are alike in every field get the same key.
    """
    named = [F.col(_quoted(c)) for c in sorted(documents.columns) if not c.startswith("@")]
    return F.sha2(F.to_json(F.struct(*named), {"ignoreNullFields": "false"}), 256)


def with_key(documents: DataFrame, specs: list[FieldSpec]) -> tuple[DataFrame, list[FieldSpec]]:
    """Documents and specs with a key: as they are, or with a generated one in front."""
    if any(s.is_key for s in specs):
        return documents, specs
    keyed = documents.withColumn(GENERATED_KEY, generated_key(documents))
    return keyed, [FieldSpec(GENERATED_KEY, GENERATED_KEY, "VARCHAR", max_length=64, is_key=True), *specs]


def transform_documents(
    documents: DataFrame, specs: list[FieldSpec], defaults: bool = True, keep_dynamic: bool | str = False
) -> DataFrame:
    """Typed target columns plus ``_reject_reason`` (null for good rows).

    With ``defaults`` missing values become the default of their type unless the field is nullable;
    otherwise they stay null. ``keep_dynamic`` keeps undeclared fields in ``$meta``: as JSON text, or with ``"variant"`` as
    a Variant.
    """
    source_types = {f.name: f.dataType for f in documents.schema.fields}
    converted, columns, reasons = [], [], []
    for position, spec in enumerate(specs):
        present = spec.source in source_types
        source = F.col(_quoted(spec.source)) if present else F.lit(None)
        source_type = source_types.get(spec.source, T.NullType())
        value, missing = F.col(f"_v{position}"), F.col(f"_n{position}")
        converted += [
            convert(source, source_type, spec).alias(f"_v{position}"),
            source.isNull().alias(f"_n{position}"),
        ]
        if present and can_fail(source_type, spec):
            reasons.append(F.when(~missing & value.isNull(), F.lit(f"bad value in {spec.source}")))
        if spec.is_key:
            reasons.append(F.when(missing, F.lit(f"missing key {spec.source}")))
        if spec.dim and spec.is_vector:
            size = F.size(value) if spec.target_type == "FLOAT_VECTOR" else F.octet_length(value)
            wanted = stored_size(spec.target_type, spec.dim)
            reasons.append(F.when(size != wanted, F.lit(f"wrong dimension in {spec.source}")))
        default = default_value(spec) if defaults and not (spec.is_key or spec.nullable) else None
        filled = value if default is None else F.coalesce(value, default)
        columns.append(filled.alias(spec.target, metadata=target_schema([spec]).fields[0].metadata))
    if keep_dynamic:
        converted.append(dynamic_fields(documents, specs, keep_dynamic == "variant").alias("$meta"))
        columns.append(F.col("`$meta`"))
    reason = F.concat_ws("; ", *reasons)
    # Two steps, so that a value and the reason drawn from it share one evaluation.
    return documents.select(*converted).select(*columns, F.when(reason != "", reason).alias(REASON))


def accepted(transformed: DataFrame) -> DataFrame:
    return transformed.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(transformed: DataFrame) -> DataFrame:
    return transformed.filter(F.col(REASON).isNotNull())


def transform_counts(transformed: DataFrame) -> DataFrame:
    """Dry run: what a load would write and reject, without writing."""
    bad = F.col(REASON).isNotNull()
    return transformed.agg(
        F.count("*").alias("total"), F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected")
    )


def array_limits(documents: DataFrame, key: str, array: str, max_capacity: int, max_length: int) -> DataFrame:
    """Rows whose array exceeds the declared capacity or element length (declared, not enforced)."""
    too_long = F.exists(array, lambda x: F.length(x) > max_length)
    return documents.select(
        key, F.size(array).alias("n_elements"),
        (F.size(array) > max_capacity).alias("over_capacity"),
        F.coalesce(too_long, F.lit(False)).alias("over_length"),
    ).filter(F.col("over_capacity") | F.col("over_length"))


def fit_array(array: Column, max_capacity: int, max_length: int) -> Column:
    """Optional enforcement of the declared limits."""
    return F.transform(F.slice(array, 1, max_capacity), lambda x: F.substring(x, 1, max_length))
