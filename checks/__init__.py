"""One Spark query and one DuckDB query per operator, on the generated tables."""

from checks import facts, files, groups, marts, rows, scorecard, states, storage  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
