"""Column-level functions (all Spark SQL built-ins)."""

from termflow.functions.text import (display_size, is_not_blank, is_term,
                                     java_split_space, java_trim, normalize_lines,
                                     notice, parse_doubles, split_lines, terms_of)
from termflow.functions.json import decode_scores, encode_scores

__all__ = ["display_size", "is_not_blank", "is_term", "java_split_space", "java_trim",
           "normalize_lines", "notice", "parse_doubles", "split_lines", "terms_of",
           "decode_scores", "encode_scores"]
