"""Column -> Column building blocks (all native Spark expressions)."""

from .hashing import canonical_json, canonical_struct, md5_of_json, row_md5
from .location import GEO_LEVELS, geo_normalise, json_path, split_location
from .parse import parse_double, parse_int, parse_partial_date
from .sequences import (fill_from_template, insertion_list, insertions_by_gene,
                        mask_edge_gaps, sorted_map, unknown_like, unknown_template)
from .text import empty_to_null, is_blank, not_blank, null_if_in, utrim

__all__ = [
    "canonical_json", "canonical_struct", "md5_of_json", "row_md5",
    "GEO_LEVELS", "geo_normalise", "json_path", "split_location",
    "parse_double", "parse_int", "parse_partial_date",
    "fill_from_template", "insertion_list", "insertions_by_gene", "mask_edge_gaps",
    "sorted_map", "unknown_like", "unknown_template",
    "empty_to_null", "is_blank", "not_blank", "null_if_in", "utrim",
]
