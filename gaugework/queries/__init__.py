"""The registered queries with their SQL counterparts."""

from gaugework.queries import preparation, scoring, tracking, training  # noqa: F401
from gaugework.queries.base import ORACLES, QUERIES  # noqa: F401
