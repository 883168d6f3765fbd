"""Errors of the library, mapped from Spark's."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager


class EngineError(Exception):
    """Any failure of a query."""


class IntegrityError(EngineError):
    """A key, check or duplicate-match rule is broken."""


class UnsupportedFeatureError(EngineError):
    """The feature is declined by design."""


class QueryError(EngineError):
    """The query can't be analysed."""


@contextmanager
def mapped() -> Iterator[None]:
    """Raises Spark's errors as the library's."""
    from pyspark.errors import AnalysisException, PySparkException

    try:
        yield
    except AnalysisException as e:
        raise QueryError(str(e)) from e
    except PySparkException as e:
        if "duplicate match" in str(e) or "constraint" in str(e):
            raise IntegrityError(str(e)) from e
        raise EngineError(str(e)) from e
