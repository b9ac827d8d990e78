"""Source readers (bound by column name) and the test-data views."""

from basketspark.sources.readers import Sources, load, read_jdbc
from basketspark.sources.fixtures import fixture_sources, read_testdata

__all__ = ["Sources", "load", "read_jdbc", "fixture_sources", "read_testdata"]
