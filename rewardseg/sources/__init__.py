"""Sources (20 logical tables with column contracts) and sinks."""

from rewardseg.sources.catalog import Sources
from rewardseg.sources.contracts import CONTRACTS, SOURCE_NAMES, conform
from rewardseg.sources.sinks import publish, stage, write_marker
from rewardseg.sources.testdata import testdata_sources

__all__ = ["Sources", "CONTRACTS", "SOURCE_NAMES", "conform", "publish", "stage",
           "write_marker", "testdata_sources"]
