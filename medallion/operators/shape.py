"""Reshaping and column-set operators."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.names import normalized_alias
from medallion.session import checkpointed


def _lower_set(names) -> set[str]:
    return {n.lower() for n in (names or [])}


def filtered_columns(df: DataFrame, except_: Sequence[str] = ()) -> list[str]:
    """Column names minus ``except_`` (case-insensitive), in source order."""
    drop = _lower_set(except_)
    return [c for c in df.columns if c.lower() not in drop]


def select_star(df: DataFrame, except_: Sequence[str] = (), prefix: str = "", suffix: str = "",
                relation_alias: str | None = None) -> DataFrame:
    """Every column but ``except_``, optionally renamed ``prefix + name + suffix``
    (P8).  With ``relation_alias`` the columns are taken from that alias (useful
    after a self-join).  No column left gives an empty projection."""
    cols = filtered_columns(df, except_)
    src = df.alias(relation_alias) if relation_alias else df
    out = []
    for c in cols:
        ref = F.col(f"{relation_alias}.`{c}`") if relation_alias else F.col(f"`{c}`")
        out.append(ref.alias(f"{prefix}{c}{suffix}") if (prefix or suffix) else ref)
    return src.select(*out)


def empty_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``nullif(col, '')`` on string columns; other columns pass through (P10).

    ``cols=None`` applies it to every column (P11), in one projection."""
    wanted = None if cols is None else _lower_set(cols)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and (wanted is None or f.name.lower() in wanted):
            out.append(F.nullif(c, F.lit("")).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def empty_to_null_table(df: DataFrame) -> DataFrame:
    return empty_to_null(df, None)


def group_by_first_n(df: DataFrame, exprs: Sequence[Column | str], n: int) -> DataFrame:
    """``select e1, …, ek … group by 1..n``: the first ``n`` expressions are keys (A10)."""
    if n < 1 or n > len(exprs):
        raise ValueError("n must be between 1 and the number of expressions")
    keys = [F.col(e) if isinstance(e, str) else e for e in exprs[:n]]
    aggs = [F.col(e) if isinstance(e, str) else e for e in exprs[n:]]
    g = df.groupBy(*keys)
    return g.agg(*aggs) if aggs else g.agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def type_of(values: Sequence) -> T.DataType:
    """Column type of Python values: whole numbers, numbers, booleans or text."""
    if all(isinstance(v, bool) for v in values):
        return T.BooleanType()
    if all(isinstance(v, int) for v in values):
        return T.LongType()
    return T.DoubleType() if all(isinstance(v, float) for v in values) else T.StringType()


def value_counts(df: DataFrame | None, column: str, order_by: str | Column = "count desc",
                 where: str | Column | None = None, max_records: int | None = None,
                 default: Sequence | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Distinct values of ``column`` with their row counts.

    ``order_by``: 'count desc' (default), 'count asc', 'value asc', 'value desc'
    or any aggregate Column; the value is always the final tie-break so the
    order is deterministic.  ``max_records`` keeps the first N values (a top-N
    report).  ``df=None`` (a missing table) gives ``default`` as rows; no
    default raises."""
    if df is None:
        if default is None:
            raise ValueError("relation does not exist and no default value was provided")
        if spark is None:
            spark = SparkSession.getActiveSession()
        kind = T.StringType() if not default else type_of(default)
        return spark.createDataFrame([(v, None) for v in default], T.StructType(
            [T.StructField("value", kind), T.StructField("n", T.LongType())]))
    src = df.where(where) if where is not None else df
    aggs = [F.count(F.lit(1)).alias("n")]
    if isinstance(order_by, Column):
        aggs.append(order_by.alias("_order"))
        ordering = [F.col("_order"), F.col("value").asc_nulls_first()]
    else:
        key = order_by.strip().lower()
        table = {
            "count desc": [F.col("n").desc(), F.col("value").asc_nulls_first()],
            "count(*) desc": [F.col("n").desc(), F.col("value").asc_nulls_first()],
            "count asc": [F.col("n").asc(), F.col("value").asc_nulls_first()],
            "count(*) asc": [F.col("n").asc(), F.col("value").asc_nulls_first()],
            "value asc": [F.col("value").asc_nulls_first()],
            "value desc": [F.col("value").desc_nulls_last()],
        }
        if key not in table:
            raise ValueError(f"unsupported order_by {order_by!r}")
        ordering = table[key]
    counted = src.groupBy(F.col(column).alias("value")).agg(*aggs)
    out = counted.orderBy(*ordering)
    if max_records is not None:
        out = out.limit(max_records)
    return out.drop("_order") if "_order" in out.columns else out


# Types that the frequent-items sketch holds.
_TRACKED_TYPES = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)


def top_values(df: DataFrame, column: str, n: int, where: str | Column | None = None, tracked: int = 10_000) -> DataFrame:
    """The ``n`` most frequent values with their counts, as ``value_counts`` gives them,
    without counting every value (A12).

    A frequent-items sketch of ``tracked`` values names candidates, which one further pass
    counts exactly; only candidates are shuffled.  They are the answer if their counts add
    up to all rows, or if the n-th of them is more frequent than any value can be that the
    sketch left out (twice its error, 3.5 / 2^ceil(log2(tracked / 0.75)) of the rows).
    Otherwise every value is counted.  NULL is always a candidate."""
    src = df.where(where) if where is not None else df
    kind = src.schema[column].dataType
    tracked = max(tracked, n + 1)
    full = value_counts(df, column, where=where, max_records=n)
    if not isinstance(kind, _TRACKED_TYPES) or tracked > 1_000_000:
        return full
    c = F.col(column)
    seen = src.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{column}`, {tracked}, {tracked})").alias("top")).first()
    items = [r["item"] for r in seen["top"] or [] if r["item"] is not None]
    counts = checkpointed(src.where(c.isNull() | c.isin(items)).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n")))
    best = counts.orderBy(F.col("n").desc(), F.col("value").asc_nulls_first()).limit(n)
    told = counts.agg(F.sum("n").alias("held")).crossJoin(best.agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("found"))).first()
    left_out = 2 * 3.5 / 2 ** math.ceil(math.log2(math.ceil(tracked / 0.75))) * seen["rows"]
    if (told["held"] or 0) == seen["rows"] or told["found"] == n and told["least"] > left_out:
        return best
    return full


def column_values(df: DataFrame | None, column: str, max_records: int | None = None, default: Sequence | None = None,
                  **kw) -> list:
    """The values of ``value_counts`` as a Python list — only for building a
    plan (pivot columns).  More than ``max_records`` values, where given, raise
    an error that names the bound; none is ever left out.
    ``default`` is returned when the table is missing or has no values."""
    if df is None:
        if default is None:
            raise ValueError("relation does not exist and no default value was provided")
        return list(default)
    probe = None if max_records is None else max_records + 1
    vals = [r["value"] for r in value_counts(df, column, max_records=probe, **kw).collect()]
    if max_records is not None and len(vals) > max_records:
        raise ValueError(f"{column} has more than {max_records} values; raise the bound or list the values")
    return vals if vals or default is None else list(default)


_CMPS = {"=": "__eq__", "!=": "__ne__", "<>": "__ne__", "<": "__lt__", "<=": "__le__",
         ">": "__gt__", ">=": "__ge__"}


# Aggregates whose value over the rows of a group follows from their values per pivot
# value; those of types the pivot aggregate holds in place.
_IN_PLACE = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _plain_values(df: DataFrame, column: str, values: Sequence) -> bool:
    """Whether the values are literals of the column's own kind, each once."""
    kind = df.schema[column].dataType if column in df.columns else None
    kinds = {T.StringType: str, T.BooleanType: bool, T.ByteType: int, T.ShortType: int, T.IntegerType: int, T.LongType: int}
    want = kinds.get(type(kind))
    return want is not None and all(type(v) is want for v in values) and len(set(values)) == len(values)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _pivot_in_place(df: DataFrame, by: Sequence[str], column: str, values: Sequence, names: Sequence[str], agg: str,
                    then_value, else_value) -> DataFrame | None:
    """The pivot in two phases, or None where its aggregate cannot be split.

    First one row per (group, value), with a partial aggregate before the shuffle; then
    Spark's pivot aggregate puts each into its place of one row per group.  A row of the
    input costs one update, whatever the number of columns."""
    then_c = then_value if isinstance(then_value, Column) else F.lit(then_value)
    if isinstance(else_value, (Column, str)) or agg == "avg" and else_value is not None or not _plain_values(df, column, values):
        return None
    fns = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg}
    whole = fns[agg](F.when(F.col(column).isNull(), then_c).otherwise(F.lit(else_value)))
    kinds = df.agg(whole.alias("x"), F.first(then_c).alias("then")).schema
    kind = kinds["x"].dataType
    if not isinstance(kind, _IN_PLACE) or not isinstance(kinds["then"].dataType, _IN_PLACE):
        return None
    # values without a column of their own share one NULL key
    key = F.when(F.col(column).isin(list(values)), F.col(column))
    sql = kind.simpleString()
    keys = [_quote(c) for c in by]
    constant = not isinstance(then_value, Column) and then_value is not None
    if else_value is None or constant and agg == "sum" and else_value == 0:
        # a value no row of the group has: NULL, or the 0 that other rows count
        wide = df.groupBy(*by, key.alias("_pv_key")).agg(fns[agg](then_c).alias("_pv_agg"))
        wide = wide.groupBy(*by).pivot("_pv_key", list(values)).agg(F.first("_pv_agg"))
        fill = else_value is not None or agg == "count"
        cells = [f"CAST({f'coalesce({_quote(c)}, 0)' if fill else _quote(c)} AS {sql}) AS {_quote(n)}"
                 for c, n in zip(wide.columns[len(by):], names)]
        return wide.selectExpr(*keys, *cells)
    # the rows of a group that do not match count with else_value: their number is the
    # group's rows less the value's; the window needs no shuffle of its own
    cells = df.groupBy(*by, key.alias("_pv_key")).agg(fns[agg](then_c).alias("_pv_agg"), F.count(F.lit(1)).alias("_pv_n"))
    total = F.sum("_pv_n").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    wide = (cells.withColumn("_pv_total", total).groupBy(*by, "_pv_total").pivot("_pv_key", list(values))
            .agg(F.first("_pv_agg").alias("a"), F.first("_pv_n").alias("n")))
    cols = wide.columns[len(by) + 1:]
    out = []
    for name, a_name, n_name in zip(names, cols[::2], cols[1::2]):
        a, rest = _quote(a_name), f"(_pv_total - coalesce({_quote(n_name)}, 0))"
        if agg == "sum":
            cell = f"CASE WHEN {rest} > 0 THEN coalesce({a}, 0) + {rest} * {_number(else_value)} ELSE {a} END"
        elif agg == "count":
            cell = f"coalesce({a}, 0) + {rest}"
        else:
            cell = f"CASE WHEN {rest} > 0 THEN {'greatest' if agg == 'max' else 'least'}({a}, {_number(else_value)}) ELSE {a} END"
        out.append(f"CAST({cell} AS {sql}) AS {_quote(name)}")
    return wide.selectExpr(*keys, *out)


def _number(value) -> str:
    """A Python number or boolean as the literal that ``lit`` makes of it."""
    return str(value).lower() if isinstance(value, bool) else f"{value!r}D" if isinstance(value, float) else str(value)


def pivot_columns(df: DataFrame, by: Sequence[str], column: str, values: Sequence | None = None,
                  agg: str = "sum", cmp: str = "=", prefix: str = "", suffix: str = "",
                  then_value=1, else_value=0, distinct: bool = False,
                  normalize_names: bool = False, max_values: int = 10_000, strategy: str = "auto") -> DataFrame:
    """One aggregate per value: ``agg(case when column <cmp> value then then_value
    else else_value end)`` grouped by ``by`` (R1).

    The default counts matches per group (0 when none).  ``values=None`` takes
    the distinct values of ``column``, most frequent first; more than
    ``max_values`` raise.  Values may hold quotes; they are passed as literals.

    ``strategy="auto"`` aggregates by (group, value) first and then places the cells
    where the comparison is ``=`` and the aggregate can be split; other pivots, and
    ``strategy="conditional"``, evaluate one expression per value and row."""
    if cmp not in _CMPS:
        raise ValueError(f"cmp must be one of {sorted(_CMPS)}")
    if strategy not in ("auto", "conditional"):
        raise ValueError("strategy must be 'auto' or 'conditional'")
    if values is None:
        values = column_values(df, column, max_records=max_values)
    fns = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg}
    distinct_fns = {"sum": F.sum_distinct, "count": F.count_distinct}
    if agg not in fns:
        raise ValueError(f"agg must be one of {sorted(fns)}")
    if distinct and agg not in distinct_fns:
        raise ValueError("distinct is supported for agg='sum' and agg='count'")
    names = [f"{prefix}{v}{suffix}" for v in values]
    names = [normalized_alias(n) if normalize_names else n for n in names]
    if strategy == "auto" and cmp == "=" and values and not distinct:
        placed = _pivot_in_place(df, by, column, values, names, agg, then_value, else_value)
        if placed is not None:
            return placed
    aggs = []
    for v, name in zip(values, names):
        cond = getattr(F.col(column), _CMPS[cmp])(F.lit(v))
        then_c = then_value if isinstance(then_value, Column) else F.lit(then_value)
        else_c = else_value if isinstance(else_value, Column) else F.lit(else_value)
        expr = F.when(cond, then_c).otherwise(else_c)
        a = distinct_fns[agg](expr) if distinct else fns[agg](expr)
        aggs.append(a.alias(name))
    return df.groupBy(*by).agg(*aggs)


def value_places(df: DataFrame, column: str, width: int) -> DataFrame:
    """The distinct values of ``column`` (NULL is one) with their places in blocks of at
    most ``width``: value, ``block`` and ``place`` below ``width`` (R1).

    For pivots to more columns than a plan holds: with ``block`` among the groups and
    ``place`` as the pivot column, a wide row is one block of columns, and the number of
    columns is bounded whatever the number of values.  Values are dealt by hash and numbered
    within their part, so none passes the driver; a part that is too full gives several blocks."""
    if width < 1:
        raise ValueError("width must be positive")
    values = df.select(F.col(column).alias("value")).distinct()
    parts = 1 + values.count() * 5 // (4 * width)  # filled to 80 % on average
    place = F.row_number().over(Window.partitionBy("_part").orderBy("value")) - 1
    numbered = values.withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(parts))).withColumn("_n", place)
    return numbered.select("value", (F.col("_part") + F.floor(F.col("_n") / width) * parts).alias("block"),
                           (F.col("_n") % width).cast("int").alias("place"))


def unpivot_columns(df: DataFrame, exclude: Sequence[str] = (), remove: Sequence[str] = (),
                    field_name: str = "field_name", value_name: str = "value",
                    cast_to: str = "string") -> DataFrame:
    """Columns to rows: one (name, value) row per input row and column (R2).

    ``exclude`` columns are kept as identifiers, ``remove`` columns dropped
    (both case-insensitive).  Values are cast to ``cast_to``; booleans become
    'true'/'false'.  One scan (an Expand), not one scan per column."""
    ex, rm = _lower_set(exclude), _lower_set(remove)
    by_lower = {c.lower(): c for c in df.columns}
    ids = [by_lower.get(e.lower(), e) for e in exclude]
    vals = [c for c in df.columns if c.lower() not in ex and c.lower() not in rm]
    if not vals:
        raise ValueError("no columns left to unpivot")
    return df.unpivot([F.col(f"`{c}`") for c in ids],
                      [F.col(f"`{c}`").cast(cast_to).alias(c) for c in vals],
                      field_name, value_name)


def deduplicate(df: DataFrame, partition_by: Sequence[Column | str],
                order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key in ``order_by`` order (R4), rows with NULLs kept.

    ``row_number() = 1`` is planned as a WindowGroupLimit that also runs before
    the shuffle, so a hot key sends one row per map task, not all its rows.
    Give a total order for a deterministic result."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_dedupe_rn", F.row_number().over(w)) \
             .where(F.col("_dedupe_rn") == 1).drop("_dedupe_rn")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with ``normalized_alias``."""
    return df.toDF(*[normalized_alias(c) for c in df.columns])


# Fixed value: default name of the column recording each row's input relation
# (kept equal to the name other tools use, so unioned outputs line up).
SOURCE_COLUMN = "_dbt_source_relation"


def superset_columns(schemas: Sequence[T.StructType], include: Sequence[str] = (), exclude: Sequence[str] = (),
                     case_sensitive: bool = False) -> dict[str, tuple[str, T.DataType]]:
    """Columns of all schemas in first-seen order: key → (name, type) as first seen.
    Unless ``case_sensitive`` 'Name' and 'name' are one column."""
    inc, exc = _lower_set(include), _lower_set(exclude)
    out: dict[str, tuple[str, T.DataType]] = {}
    for schema in schemas:
        for f in schema.fields:
            low = f.name.lower()
            if not ((exc and low in exc) or (inc and low not in inc)):
                out.setdefault(f.name if case_sensitive else low, (f.name, f.dataType))
    return out


def union_relations(relations: Mapping[str, DataFrame] | Sequence[DataFrame],
                    include: Sequence[str] = (), exclude: Sequence[str] = (),
                    column_override: Mapping[str, str] | None = None,
                    source_column: str | None = SOURCE_COLUMN,
                    where: str | Column | None = None) -> DataFrame:
    """Union by name over the superset of columns.

    Columns appear in first-seen order; the first seen type wins (or
    ``column_override``); an input lacking a column gets a typed NULL;
    ``include`` / ``exclude`` are exclusive and case-insensitive; each row
    records its input's name in ``source_column`` (``None`` omits it);
    ``where`` filters every input."""
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    named = list(relations.items()) if isinstance(relations, Mapping) else \
        [(f"relation_{i}", r) for i, r in enumerate(relations)]
    if not named:
        raise ValueError("no relations to union")
    override = {k.lower(): v for k, v in (column_override or {}).items()}
    # Spark resolves names case-insensitively by default: 'Name' and 'name'
    # are one column, spelled as first seen.
    case_sensitive = named[0][1].sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    superset = superset_columns([r.schema for _, r in named], include, exclude, case_sensitive)
    if not superset:
        raise ValueError(f"nothing to union: include / exclude leave no column of {', '.join(n for n, _ in named)}")
    parts = []
    for name, rel in named:
        mine = {k: c for k, (c, _) in superset_columns([rel.schema], case_sensitive=case_sensitive).items()}
        sel = [F.lit(name).cast("string").alias(source_column)] if source_column else []
        for key, (c, dtype) in superset.items():
            target = override.get(c.lower(), dtype)
            src = F.col(f"`{mine[key]}`") if key in mine else F.lit(None)
            sel.append(src.cast(target).alias(c))
        r = rel.where(where) if where is not None else rel
        parts.append(r.select(*sel))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
