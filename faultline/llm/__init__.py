"""Operators for training-data pipelines over documents, pages and vectors.

Nothing else in the library imports this subpackage. Python helpers that run
inside tasks are pickled by value, so executors need no copy of the library.
"""

from __future__ import annotations
