"""Independent SQL statements that the Spark results are compared with."""

from oracles.statements import STATEMENTS

__all__ = ["STATEMENTS"]
