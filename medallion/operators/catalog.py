"""Relation discovery and query-result attachments."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.shape import SOURCE_COLUMN, superset_columns, union_relations


def _like_to_regex(pattern: str) -> re.Pattern:
    out = []
    for ch in pattern:
        out.append(".*" if ch == "%" else "." if ch == "_" else re.escape(ch))
    return re.compile("^" + "".join(out) + "$", re.IGNORECASE)


def quoted(name: Sequence[str]) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name)


def _matching(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "",
              kinds: Sequence[str] | None = None) -> dict[str, tuple[str, ...]]:
    """Display name → name parts of the relations that match."""
    tp, ep = _like_to_regex(table_pattern), _like_to_regex(exclude) if exclude else None
    sp = _like_to_regex(schema_pattern)
    found: dict[str, tuple[str, ...]] = {}
    # temporary views belong to no database and are listed with each
    seen_in = [d.name for d in spark.catalog.listDatabases() if sp.match(d.name)]
    temporary = sp.match("") is not None
    for db in seen_in or ([spark.catalog.currentDatabase()] if temporary else []):
        for t in spark.catalog.listTables(quoted([db])):
            if t.isTemporary and not temporary or not t.isTemporary and db not in seen_in:
                continue
            if not tp.match(t.name) or (ep and ep.match(t.name)):
                continue
            if kinds and t.tableType.lower() not in {k.lower() for k in kinds}:
                continue
            parts = (t.name,) if t.isTemporary else (*t.namespace, t.name)
            found[".".join(parts)] = parts
    return dict(sorted(found.items()))


def relations_matching(spark: SparkSession, schema_pattern: str, table_pattern: str,
                       exclude: str = "", kinds: Sequence[str] | None = None) -> list[str]:
    """Qualified names of tables/views whose database and name match the SQL
    ``LIKE`` patterns (``%`` / ``_``), case-insensitive, sorted, in every database of
    the current catalog.  Temporary views belong to no database: ``%`` finds them."""
    return list(_matching(spark, schema_pattern, table_pattern, exclude, kinds))


def _place(spark: SparkSession, name: Sequence[str]) -> str | None:
    """Folder of a table that is plain Parquet files without partitions, else None."""
    if len(name) < 2:
        return None
    info = {}
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect():
        info.setdefault(r["col_name"], r["data_type"])
    if info.get("Provider", "").lower() != "parquet" or "# Partition Information" in info:
        return None
    return info.get("Location")


def _short(path: Column) -> Column:
    """A path without the slashes that only some spellings of it have."""
    return F.regexp_replace(F.rtrim(path, F.lit("/")), "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def scan_relations(spark: SparkSession, places: Mapping[str, str], schema: T.StructType, source_column: str) -> DataFrame:
    """One scan over the files of many tables.  A row's table follows from its file's
    folder by a join with the table names (a row per table, as many as the catalog names);
    a table without a column of ``schema`` gives NULL there."""
    rows = spark.read.schema(schema).parquet(*places.values())
    folder = _short(F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)))
    names = spark.createDataFrame([(n, p) for n, p in places.items()], f"`{source_column}` string, _place string")
    names = names.select(F.col(f"`{source_column}`"), _short(F.url_decode("_place")).alias("_place"))
    return (rows.withColumn("_folder", folder).join(F.broadcast(names), F.col("_folder") == F.col("_place"))
            .select(f"`{source_column}`", *[F.col(f"`{f.name}`") for f in schema]))


def union_matching(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "",
                   kinds: Sequence[str] | None = None, **union_kw) -> DataFrame:
    """Union every table whose name matches, in all databases (D1); no match raises.

    Tables that are plain Parquet files and agree on the types of the columns they
    share are read by one scan, however many there are; views and others join it as
    inputs of ``union_relations``, which defines the result."""
    names = _matching(spark, schema_pattern, table_pattern, exclude, kinds)
    if not names:
        raise ValueError(f"no relation matches {schema_pattern}.{table_pattern}")
    frames = {n: spark.table(quoted(p)) for n, p in names.items()}
    sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    columns = superset_columns([f.schema for f in frames.values()], case_sensitive=sensitive)
    alike = [n for n, f in frames.items() if all(columns[c.name if sensitive else c.name.lower()] == (c.name, c.dataType) for c in f.schema)]
    places = {n: p for n in alike if (p := _place(spark, names[n]))}
    if len(places) < 2 or len(set(places.values())) < len(places):
        return union_relations(frames, **union_kw)
    source = union_kw.get("source_column", SOURCE_COLUMN)
    wanted = superset_columns([f.schema for f in frames.values()], union_kw.get("include", ()), union_kw.get("exclude", ()), sensitive)
    others = {n: f for n, f in frames.items() if n not in places}
    if (not wanted or union_kw.get("include") and union_kw.get("exclude")  # raises
            or others and not superset_columns([f.schema for f in others.values()], union_kw.get("include", ()), union_kw.get("exclude", ()))):
        return union_relations(frames, **union_kw)
    held = superset_columns([frames[n].schema for n in places], case_sensitive=sensitive)
    scanned = scan_relations(spark, places, T.StructType([T.StructField(c, t) for c, t in held.values()]), "_scan_source")
    if (where := union_kw.get("where")) is not None:
        scanned = scanned.where(where)
    override = {k.lower(): v for k, v in (union_kw.get("column_override") or {}).items()}
    out = scanned.select(*([F.col("_scan_source").alias(source)] if source else []),
                         *[(F.col(f"`{c}`") if key in held else F.lit(None)).cast(override.get(c.lower(), t)).alias(c)
                           for key, (c, t) in wanted.items()])
    if others:
        typed = {c: override.get(c.lower(), t) for c, t in wanted.values()}
        out = out.unionByName(union_relations(others, **union_kw | {"column_override": typed}), allowMissingColumns=True)
    return out


def union_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "",
                    **union_kw) -> DataFrame:
    """Union every table named ``prefix…`` (D2).  In ``prefix`` the characters ``%``
    and ``_`` are those of LIKE."""
    return union_matching(spark, schema, prefix + "%", exclude, **union_kw)


def with_scalar(df: DataFrame, query: DataFrame, name: str, default=None) -> DataFrame:
    """Attach the first column of the query's first row to every row (D3).

    ``query`` should give at most one row (an aggregate); its first row is
    broadcast (one row: a proven size bound).  ``default`` applies only when the
    query has no rows, not when its value is NULL."""
    first = query.select(F.col(query.columns[0]).alias(name), F.lit(True).alias("_has_row")).limit(1)
    out = df.join(F.broadcast(first), how="left")
    value = F.when(F.col("_has_row").isNull(), F.lit(default)).otherwise(F.col(name)) \
        if default is not None else F.col(name)
    return out.withColumn(name, value).drop("_has_row")


def columns_as_arrays(df: DataFrame, cols: Sequence[str], order_by: Sequence[str | Column],
                      by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by`` group) holding one array per column, aligned in
    ``order_by`` order, NULLs kept (D4).  Structs are collected — a plain
    ``collect_list`` would drop NULLs.  Each group's arrays live in one row, so
    use ``by`` keys whose groups are small enough for one row."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order_cols)]
    packed = F.struct(*keys, *[F.col(c).alias(c) for c in cols])
    agg = df.groupBy(*by).agg(F.sort_array(F.collect_list(packed)).alias("_rows"))
    def field(name):
        return lambda r: r.getField(name)
    return agg.select(*by, *[F.transform("_rows", field(c)).alias(c) for c in cols])
