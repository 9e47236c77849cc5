"""The registered queries: one per operator, each over the whole given tables."""

from codeloom.catalog.registry import REGISTRY, Tables

# importing a module registers its queries
from codeloom.catalog import scalar, dictionaries, candidates, semantic, featuring, learning, jobs  # noqa: E402,F401

__all__ = ["REGISTRY", "Tables"]
