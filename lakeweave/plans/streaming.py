"""Registry shim: the streaming jobs are registered like any other family."""

from ..streaming import incremental, jobs

QUERIES = {**incremental.QUERIES, **jobs.QUERIES}
