"""Imports every catalog module so that its queries are registered."""

from catalog import (cleaning_queries, corpus_queries, feature_queries, model_queries, profile_queries,  # noqa: F401
                     row_queries, source_queries, stat_queries, summary_queries, text_queries)
