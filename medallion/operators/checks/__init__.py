"""Table checks: each returns a ``Check`` whose ``failing_rows()`` is empty
when the assertion holds; ``run_checks`` builds one report."""

from medallion.operators.checks.core import Check, threshold  # noqa: F401
from medallion.operators.checks.row import (  # noqa: F401
    accepted_range, accepted_values, assert_equal, at_least_one, expression_is_true, not_accepted_values,
    not_constant, not_empty_string, not_null, not_null_proportion, recency, unique, unique_combination,
)
from medallion.operators.checks.relation import (  # noqa: F401
    cardinality_equality, columns_match_set, equal_rowcount, equality, fewer_rows_than, relationships_where,
)
from medallion.operators.checks.window import mutually_exclusive_ranges, sequential_values  # noqa: F401
from medallion.operators.checks.runner import failed, run_checks  # noqa: F401
from medallion.operators.checks.incremental import CheckStates  # noqa: F401
