"""All registered queries and their SQL."""

from trailforge.plans import io_queries, report_queries  # noqa: F401 (they register theirs)
from trailforge.plans.queries import ORACLE_SQL, QUERIES, url_domain_top20  # noqa: F401
