"""The registered queries, each with equivalent SQL where SQL can express it."""

from workload.oracles import ORACLES
from workload.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
