"""The published queries, by topic. Importing this package registers them all."""

from sparrowmill.catalog import (  # noqa: F401
    aggregates,
    benchmark,
    history,
    joins,
    layers,
    quality,
    rows,
    scalars,
    sets,
    storage,
    views,
    windows,
)
