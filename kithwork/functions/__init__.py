from .columns import (
    age_units,
    dot,
    full_name,
    number_list,
    split_fields,
    spread_hash,
    street_address,
)

__all__ = [
    "age_units",
    "dot",
    "full_name",
    "number_list",
    "split_fields",
    "spread_hash",
    "street_address",
]
