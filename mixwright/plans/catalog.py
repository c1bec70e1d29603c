"""Named queries and the same as SQL, gathered from the modules of this folder."""

from mixwright.plans import budget_queries, cleaning_queries, feature_queries, fit_queries, media_queries, model_queries, report_queries, review_queries, table_queries
from mixwright.plans.media_queries import flagship

MODULES = (media_queries, table_queries, feature_queries, model_queries, budget_queries, cleaning_queries, fit_queries, report_queries, review_queries)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: text for m in MODULES for name, text in m.ORACLE.items()}

__all__ = ["QUERIES", "ORACLE", "flagship"]
