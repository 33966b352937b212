"""Column-level functions: string extraction, dictionary codes, bins and small arithmetic."""

from tabwright.functions.codes import (clip, collapse, convex, family_size_bin, group_size_bin,  # noqa: F401
                                       lookup, nan_to_null, overwrite_where, range_bins, threshold)
from tabwright.functions.text import (before_first, extract_or_null, first_char, first_digits,  # noqa: F401
                                      honorific, last_digits, qcol)
