"""Every operator on the star-schema and event tables, with the SQL that must give the same rows."""

from trackloom.queries import alignment, clouds, curation, dataset, geometry, quality, records, sources, streams, tracks  # noqa: F401
from trackloom.queries.registry import ORACLES, QUERIES  # noqa: F401
