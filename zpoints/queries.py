"""All registered queries of the library and their oracles."""

from zpoints import registry, registry_stores

QUERIES = registry.QUERIES | registry_stores.QUERIES
ORACLES = registry.ORACLES | registry_stores.ORACLES
