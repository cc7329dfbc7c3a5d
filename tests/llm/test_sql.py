"""Operators against their SQL over the small tables; those with tests of their own have theirs there."""

import pytest


@pytest.mark.parametrize("name, table", [("op3_warc", "pages"), ("op4_repeated_passages", "documents"),
                                         ("op6_near_dedup", "documents"),
                                         ("op10_vector_links", "embeddings")])
def test_query_equals_sql(equals_sql, name, table):
    equals_sql(name, table)
