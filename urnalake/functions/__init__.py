"""Column expressions."""

from urnalake.functions.casting import cast_by_name, does_not_conform, nullify_tokens, strict_cast
from urnalake.functions.places import region_dimension, region_of, row_type_of, state_name_of
from urnalake.functions.rates import percentage
from urnalake.functions.text import (
    dataset_id,
    grouped_text,
    is_valid_origin,
    percent_text,
    sample_key,
    source_id,
)

__all__ = [
    "cast_by_name",
    "dataset_id",
    "does_not_conform",
    "grouped_text",
    "is_valid_origin",
    "nullify_tokens",
    "percent_text",
    "percentage",
    "region_dimension",
    "region_of",
    "row_type_of",
    "sample_key",
    "source_id",
    "state_name_of",
    "strict_cast",
]
