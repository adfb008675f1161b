"""Registered queries."""

from pagewright.plans import (  # noqa: F401
    audit_queries,
    fidelity_queries,
    geometry_queries,
    inventory_queries,
    knowledge_queries,
    markup_queries,
    page_queries,
    stream_queries,
)
from pagewright.plans.registry import ORACLE, QUERIES  # noqa: F401
