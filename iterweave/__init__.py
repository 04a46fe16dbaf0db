"""Iterative, multi-source analytics as Spark DataFrame programs."""

from iterweave.workspace import Workspace

__all__ = ["Workspace"]
