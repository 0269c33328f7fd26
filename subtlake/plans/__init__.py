"""Named queries on the given tables, each with the SQL that must give the same result."""

from subtlake.plans import (  # noqa: F401
    ads, archives, completeness, dumps, fetches, filters, groups, joins, names, ordering, sequences, statistics,
    streaming, titles,
)
from subtlake.plans.registry import ORACLE, QUERIES  # noqa: F401
