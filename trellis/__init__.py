"""trellis: a property-graph and usage-metrics engine on Spark DataFrames."""

from trellis.model import Graph
from trellis.session import build_session

__all__ = ["Graph", "build_session"]
