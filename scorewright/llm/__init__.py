"""Operators for training-data pipelines; importing the package fills its registry."""

from scorewright.llm import contracts  # noqa: F401
from scorewright.llm.base import ORACLES, QUERIES  # noqa: F401
