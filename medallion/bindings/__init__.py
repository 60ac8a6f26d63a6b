"""Binding of the operators to the driver's test tables.

Each module exposes ``QUERIES`` (name → callable(spark, sf_dir) → DataFrame)
and ``ORACLE`` (name → SQL text over the same tables, for an independent
engine).  Every query reads whole tables; nothing is sampled or capped."""
