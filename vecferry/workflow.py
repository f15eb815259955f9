"""The two calls that most loads need: ``migrate`` documents of one index, and ``validate`` what was stored.

Both take the conversions of the catalog and derive columns, key and vector fields from them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vecferry.functions.coerce import FieldSpec
from vecferry.operators import checks, reconcile, transform
from vecferry.sources import target


@dataclass(frozen=True)
class Migrated:
    """What a load left: where its rows are, their counts by outcome, and the specs it followed."""

    path: str
    specs: list[FieldSpec]
    accepted: int
    rejected: int

    def stored(self, spark: SparkSession) -> DataFrame:
        return target.read_outcome(spark, self.path, "accepted")


def migrate(
    documents: DataFrame, conversions: DataFrame, index_name: str, path: str, defaults: bool = True, keep_dynamic: bool = False,
    resolved: DataFrame | None = None,
) -> Migrated:
    """Loads the documents of one index: typed rows below ``path``, rejected ones apart with their reasons, in one pass.

    An index without a key gets a generated one. ``resolved`` adds index type and metric to the columns' metadata.
    """
    specs = transform.field_specs(conversions, index_name, resolved=resolved)
    documents, specs = transform.with_key(transform.strip_metadata(documents), specs)
    counted = target.write_outcomes(transform.transform_documents(documents, specs, defaults, keep_dynamic), path)
    return Migrated(path, specs, counted["accepted"], counted["rejected"])


def validate(
    conversions: DataFrame, index_name: str, source: DataFrame, stored: DataFrame, defaults: bool = True,
    tolerance_pct: float = checks.COUNT_TOLERANCE_PCT, threshold_pct: float = checks.FILL_RATE_PCT, digest: bool = True,
) -> DataFrame:
    """All checks of one loaded index, a row each: counts, fields, fill rate, dimensions, values and vectors by key.

    Values are compared with what the source converts to, so rows that were rejected for good reason are no difference;
    the count check sees them. Wide values are compared by digest.
    """
    specs = transform.field_specs(conversions, index_name)
    documents, specs = transform.with_key(transform.strip_metadata(source), specs)
    key = next(s.target for s in specs if s.is_key)
    expected = transform.accepted(transform.transform_documents(documents, specs, defaults))
    present = [s for s in specs if s.target in stored.columns]
    scalars = [s.target for s in present if not s.is_vector]
    parts = [
        checks.check_count(source, stored, tolerance_pct),
        checks.check_columns(len(specs), stored),
        checks.check_fill_rate(stored, scalars, threshold_pct),
    ]
    for spec in present:
        if spec.is_vector and spec.dim:
            parts.append(checks.check_dimension(stored, spec.target, spec.dim, spec.target_type))
    packed = [s.target for s in present if s.is_vector and isinstance(stored.schema[s.target].dataType, T.BinaryType)]
    compared = [c for c in scalars if c != key] + packed
    if compared:
        parts.append(checks.check_reconciled(reconcile.reconcile(expected, stored, key, compared, digest)))
    for spec in present:
        if spec.target_type == "FLOAT_VECTOR":
            agreement = reconcile.vector_agreement(expected, stored, key, spec.target)
            parts.append(checks.check_vectors(agreement, spec.target))
    return reduce(DataFrame.unionByName, parts)
