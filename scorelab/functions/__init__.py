"""Column-level building blocks (no DataFrame, no shuffle)."""

from scorelab.functions.banding import band, experience_group, fixed_bin, quadrant_label
from scorelab.functions.encode import (
    capped,
    lookup,
    multiselect_count,
    ordinal,
    parse_number,
    ranked,
    weighted_sum_capped,
)
from scorelab.functions.display import (
    bin_centre,
    bin_label,
    fixed_text,
    percent_text,
    shorten_role,
    thousands_text,
)
from scorelab.functions.hashing import hash_jitter, hash_key

__all__ = [
    "band", "experience_group", "fixed_bin", "quadrant_label",
    "capped", "lookup", "multiselect_count", "ordinal", "parse_number", "ranked",
    "weighted_sum_capped",
    "bin_centre", "bin_label", "fixed_text", "percent_text", "shorten_role", "thousands_text",
    "hash_jitter", "hash_key",
]
