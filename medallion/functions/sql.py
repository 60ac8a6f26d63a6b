"""The scalar expressions as SQL functions.

``register_functions`` defines them in the session as SQL functions: their bodies are
expressions that the analyser puts in place of each call, so Catalyst plans a query as if
it had been written out, and no function is called for a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from medallion.functions.keys import SURROGATE_NULL_TOKEN

_MANY = 8


def _variadic(kind: str, sign: str) -> tuple[str, str]:
    """Parameters and body over up to eight values; those left out are 0."""
    names = [f"x{i}" for i in range(1, _MANY + 1)]
    args = ", ".join(f"{n} {kind}" + (f" DEFAULT CAST(0 AS {kind})" if i else "") for i, n in enumerate(names))
    return args, f" {sign} ".join(f"coalesce({n}, CAST(0 AS {kind}))" for n in names)


def _snap(digits: int) -> str:
    return (f"CASE WHEN abs(x) < 1e17D THEN CAST(round(CAST(x AS DECIMAL(28,10)), {digits}) AS DOUBLE) "
            f"ELSE round(x, {digits}) END")


_HOST = "replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', '')"
_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"
_CHORD = ("pow(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) "
          "* pow(sin(radians((lon2 - lon1) / 2)), 2)")
_BIN = "((hi - lo) / n)"

#: name → (parameters, type, body).
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "safe_add": (_variadic("DOUBLE", "+")[0], "DOUBLE", _variadic("DOUBLE", "+")[1]),
    "safe_subtract": (_variadic("DOUBLE", "-")[0], "DOUBLE", _variadic("DOUBLE", "-")[1]),
    "safe_divide": ("numerator DOUBLE, denominator DOUBLE", "DOUBLE", "numerator / nullif(denominator, 0D)"),
    "null_if_zero": ("x DOUBLE", "DOUBLE", "nullif(x, 0D)"),
    "surrogate_key": (f"parts ARRAY<STRING>, nulls STRING DEFAULT '{SURROGATE_NULL_TOKEN}'", "STRING",
                      "md5(array_join(transform(parts, p -> coalesce(p, nulls)), '-'))"),
    "width_bucket_compat": ("x DOUBLE, lo DOUBLE, hi DOUBLE, n INT", "BIGINT",
                            f"CASE WHEN try_mod(CAST(x AS DECIMAL(28,6)), CAST({_BIN} AS DECIMAL(28,6))) = 0 THEN 1 ELSE 0 END "
                            f"+ least(ceil((x - lo) / {_BIN}), CAST(n + 1 AS BIGINT))"),
    "haversine": ("lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE, unit STRING DEFAULT 'mi'", "DOUBLE",
                  f"2 * 3961 * asin(sqrt({_CHORD})) * CASE unit WHEN 'mi' THEN 1D WHEN 'km' THEN 1.60934D "
                  "ELSE CAST(raise_error('unit must be mi or km') AS DOUBLE) END"),
    "degrees_to_radians": ("x DOUBLE", "DOUBLE", "radians(x)"),
    "url_host": ("url STRING", "STRING", f"split_part(split_part({_HOST}, '/', 1), '?', 1)"),
    "url_path": ("url STRING", "STRING",
                 f"split_part(right({_BARE}, length({_BARE}) - coalesce(nullif(locate('/', {_BARE}), 0), locate('?', {_BARE}) - 1)), '?', 1)"),
    "url_parameter": ("url STRING, name STRING", "STRING",
                      "nullif(split_part(split_part(url, concat(name, '='), 2), '&', 1), '')"),
    "pct_of": ("hits DOUBLE, n BIGINT", "DOUBLE", _snap(1).replace("x", "(100D * hits / nullif(n, 0))")),
    **{f"snap_round_{d}": ("x DOUBLE", "DOUBLE", _snap(d)) for d in range(7)},
}


def function_sql(name: str) -> str:
    """The statement that defines one of ``FUNCTIONS`` for the session."""
    args, kind, body = FUNCTIONS[name]
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}"


def register_functions(spark: SparkSession, names: Sequence[str] | None = None) -> list[str]:
    """Define the functions (all by default) in the session; returns their names."""
    names = list(FUNCTIONS if names is None else names)
    for n in names:
        spark.sql(function_sql(n))
    return names
