"""Document plans: the declarative spec, its builder, the insurance document."""

from .spec import BuildOptions, Child, DocSpec, Lookup, build

__all__ = ["BuildOptions", "Child", "DocSpec", "Lookup", "build"]
