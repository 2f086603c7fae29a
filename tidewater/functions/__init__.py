"""Column -> Column helpers (built-in Spark SQL functions only)."""

from tidewater.functions.dates import date_key, date_parts, end_of_time
from tidewater.functions.keys import durability_key, hash_key, key_text, packed_text, unpacked_text
from tidewater.functions.scoring import nonblank_count, result_from_score, score_bin, score_from_result
from tidewater.functions.text import (blank_to_null, clean_name, is_blank, is_zip5, latitude_from,
                                      longitude_from, mentions_any, not_blank, parse_date, safe_cast,
                                      safe_int, trim_spaces, upper_trim, zip_first5, zip_pad)
from tidewater.functions.violations import delimited_parts, slot_parts

__all__ = [
    "date_key", "date_parts", "end_of_time", "durability_key", "hash_key", "key_text",
    "nonblank_count", "result_from_score", "score_bin", "score_from_result", "blank_to_null",
    "clean_name", "is_blank", "is_zip5", "latitude_from", "longitude_from", "mentions_any",
    "not_blank", "parse_date", "safe_cast", "safe_int", "trim_spaces", "upper_trim", "zip_first5",
    "zip_pad", "delimited_parts", "slot_parts", "packed_text", "unpacked_text",
]
