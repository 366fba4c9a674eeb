"""nestdoc: fold flat, normalised tables into nested document tables on Spark.

Public entry points:

* :func:`nestdoc.operators.nest.nest` / :func:`unnest` - lists of structs per key
* :func:`nestdoc.operators.joins.join_split` - matched and unmatched join parts
* :class:`nestdoc.plans.spec.DocSpec` + :func:`build` - documents from a spec
* :mod:`nestdoc.plans.insurance` - the policy document and its stages
* :mod:`nestdoc.sources` - fixed-schema readers
* :mod:`nestdoc.sinks` - Parquet / table writers with a run report
"""

from .operators.joins import JoinParts, join_split
from .operators.nest import nest, unnest
from .plans.spec import BuildOptions, Child, DocSpec, Lookup, build

__all__ = [
    "BuildOptions",
    "Child",
    "DocSpec",
    "JoinParts",
    "Lookup",
    "build",
    "join_split",
    "nest",
    "unnest",
]
