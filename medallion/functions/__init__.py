"""Column → Column expressions.  All are built-in Spark expressions, so they
stay inside whole-stage codegen; no Python UDF is involved anywhere."""

from medallion.functions.numeric import (  # noqa: F401
    snap_round, exact_avg, rounded_avg, pct_of_total, mean_of, weighted_mean,
    safe_add, safe_subtract, safe_divide, null_if_zero, width_bucket, haversine,
    degrees_to_radians,
)
from medallion.functions.categorical import band, flag_contains, map_groups  # noqa: F401
from medallion.functions.keys import surrogate_key, SURROGATE_NULL_TOKEN  # noqa: F401
from medallion.functions.web import url_host, url_path, url_parameter  # noqa: F401
from medallion.functions.dates import (  # noqa: F401
    date_add_part, date_floor, intervals_between,
)
from medallion.functions.names import normalized_alias  # noqa: F401
