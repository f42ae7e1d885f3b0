"""Every registered query with its SQL where SQL can say it.

Times and dates leave the queries as text, and fractions rounded to six places,
so that two engines print the same values.
"""

from threatlens.plans.checks import cleaning, counting, enriching, modelling, moving, pointing, storing, streaming
from threatlens.plans.checks.registry import oracle_sql, queries

__all__ = ["cleaning", "counting", "enriching", "modelling", "moving", "oracle_sql", "pointing", "queries", "storing", "streaming"]
