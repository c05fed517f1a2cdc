"""Every operator as a runnable query over the test tables, with the same answer in SQL."""

from __future__ import annotations

from . import cleaning, columns_and_rows, folds, learning, profiling, testing  # noqa: F401
from .base import QUERIES, SQL  # noqa: F401
