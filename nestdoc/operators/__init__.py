"""Relational operators: the nest (group into lists) and the split join."""

from .joins import JoinParts, join_split
from .nest import nest, unnest

__all__ = ["JoinParts", "join_split", "nest", "unnest"]
