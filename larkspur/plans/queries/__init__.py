"""Registered queries by family. Importing this package fills the registry."""

from larkspur.plans.queries import (  # noqa: F401
    evaluation,
    features,
    joins,
    models,
    monitoring,
    preparation,
    sampling,
    sources,
    streams,
    tables,
)
