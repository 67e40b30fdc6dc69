"""All registered queries of the library's own operators, and their SQL."""

from __future__ import annotations

from sluice.plans import jobs, monitoring, relational, scoring, sinks, streams  # noqa: F401  they register on import
from sluice.plans.base import QUERIES, SQL  # noqa: F401
