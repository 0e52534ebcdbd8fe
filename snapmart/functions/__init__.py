"""Column-level helpers; every one returns a built-in Spark expression."""

from snapmart.functions.ordering import asc_nulls_last, desc_nulls_first
from snapmart.functions.variant import as_bool, as_date, as_double, as_number, as_string, as_ts_ntz, vpath
from snapmart.functions.timefmt import day_start_ntz, epoch_to_ntz, file_stamp, iso_date, iso_utc, ntz_to_epoch
from snapmart.functions.money import cents_to_usd
from snapmart.functions.text import name_key, sorted_distinct_join

__all__ = [
    "asc_nulls_last", "desc_nulls_first",
    "as_bool", "as_date", "as_double", "as_number", "as_string", "as_ts_ntz", "vpath",
    "day_start_ntz", "epoch_to_ntz", "iso_utc", "iso_date", "file_stamp", "ntz_to_epoch",
    "cents_to_usd", "name_key", "sorted_distinct_join",
]
