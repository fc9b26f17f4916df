"""Operations of a training-data pipeline as Spark jobs: one module for each operator."""

from orderdw.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
