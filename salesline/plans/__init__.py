"""Registered queries, grouped like the operators they exercise."""

from salesline.plans import cleaning, datasets, features, forecasting, reports, sources, streams, training
from salesline.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


__all__ = ["cleaning", "datasets", "features", "forecasting", "reports", "sources", "streams", "training"]
