from .text import (suffix_of, suffix_of_name, basename, collapse_ws, split_ws, strip_last,
                   percent_text, blank_to_default, text_or_empty)
from .timefmt import (micros_ntz, parse_date_time_ntz, format_elapsed, date_sentinel,
                      run_date_text)
from .encode import encode_map

__all__ = ["suffix_of", "suffix_of_name", "basename", "collapse_ws", "split_ws", "strip_last",
           "percent_text", "blank_to_default", "text_or_empty", "micros_ntz",
           "parse_date_time_ntz", "format_elapsed", "date_sentinel", "run_date_text",
           "encode_map"]
