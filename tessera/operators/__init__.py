"""DataFrame -> DataFrame operators: joins, aggregates, top-k, nested, sampling."""

from tessera.operators import aggregates, joins, nested, sampling, topk  # noqa: F401
