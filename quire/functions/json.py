"""JSON message helpers: encode/decode with built-ins only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def encode(*cols: str | Column, keep_nulls: bool = False) -> Column:
    """Struct of ``cols`` -> JSON text.

    ``keep_nulls=False`` omits NULL fields (Spark's default ``to_json``);
    ``keep_nulls=True`` writes them as ``null`` like a Python ``json.dumps``.
    """
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*cols), opts)


def decode(value: str | Column, schema: StructType) -> Column:
    """Permissive parse: malformed text gives a struct of NULLs, never an error."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v.cast("string"), schema)


def json_field(v: Column, path: str, type_: str, missing_default: Column | None = None,
               null_value: Column | None = None, strict_type: str | None = None) -> Column:
    """Read ``path`` of a VARIANT, telling a missing field from an explicit null.

    ``missing_default`` is used when the path does not exist (Python's
    ``dict.get(k, default)``); ``null_value`` when it holds JSON ``null``
    (defaults to SQL NULL). With ``strict_type`` (e.g. ``"BOOLEAN"``) a value
    of any other JSON type is NULL instead of being converted.
    """
    raw = F.try_variant_get(v, path, "variant")
    typed = F.try_variant_get(v, path, type_)
    if strict_type is not None:
        typed = F.when(F.schema_of_variant(raw) == F.lit(strict_type), typed)
    out = F.when(raw.isNull(), missing_default if missing_default is not None else F.lit(None))
    out = out.when(F.is_variant_null(raw), null_value if null_value is not None else F.lit(None))
    return out.otherwise(typed)


def python_text(v: Column, path: str) -> Column:
    """Text of the JSON value at ``path`` as Python's ``str()`` renders the
    parsed value for scalars: booleans as ``True``/``False``, everything else
    as its JSON text (strings unquoted)."""
    raw = F.try_variant_get(v, path, "variant")
    as_bool = F.when(F.try_variant_get(v, path, "boolean"), F.lit("True")).otherwise(F.lit("False"))
    return F.when(F.schema_of_variant(raw) == F.lit("BOOLEAN"), as_bool) \
        .otherwise(F.try_variant_get(v, path, "string"))


def parse_once(parsed: Column) -> Column:
    """Wrap a parse expression so each row is parsed exactly once.

    The optimizer pushes a filter on parsed fields below the projection that
    parses, copying the (pruned) parse into every predicate, so one message
    is parsed once per predicate and once more for the output. A
    one-element ``explode`` is a Generate node that predicates on its output
    cannot be pushed through; use as ``select(parse_once(...).alias(...))``.
    """
    return F.explode(F.array(parsed))
