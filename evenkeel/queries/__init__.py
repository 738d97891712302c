"""One registered query per operator over the given tables, with its SQL statement."""

from evenkeel.queries import (  # noqa: F401
    binning_queries,
    evaluation_queries,
    feed_queries,
    filter_queries,
    merge_queries,
    resampling_queries,
    scaling_queries,
    source_queries,
    stream_queries,
)
from evenkeel.queries.registry import QUERIES, SQL  # noqa: F401
