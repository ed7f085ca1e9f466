"""graphloom: property-graph analytics written as plain Spark DataFrame jobs."""

from graphloom.graph import Graph
from graphloom.session import build_session, cut

__all__ = ["Graph", "build_session", "cut"]
