"""labelloom: curation, splitting, training and error analysis of labelled text as Spark jobs.

Every operator takes and returns DataFrames. Operators whose result depends on row order take an
explicit order column, so that results never depend on how the input is partitioned.
"""

from labelloom.config import (
    FeatureSpec,
    MappingSpec,
    QualitySpec,
    RunConfig,
    SplitSpec,
)

__all__ = ["FeatureSpec", "MappingSpec", "QualitySpec", "RunConfig", "SplitSpec"]
