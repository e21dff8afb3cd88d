"""Column-level helpers. All of them are built-in Spark expressions (codegen, no Python)."""

from .scalar import (  # noqa: F401
    array_dot, array_norm, cosine, epoch_seconds, java_trim, log10_count, rating_month, round6,
    split_fields,
)
