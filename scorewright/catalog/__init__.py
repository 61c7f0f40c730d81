"""All registered queries; importing this package fills the registry."""

from scorewright.catalog import (  # noqa: F401
    aggregates,
    evaluation,
    monitoring,
    plugins,
    sources,
    streams,
    transforms,
    validation,
)
from scorewright.catalog.base import ORACLES, QUERIES  # noqa: F401
