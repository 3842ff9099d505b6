"""Each query against DuckDB on the smallest tables."""

import pytest
from conftest import DATA, same

from spanforge.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    same(catalogue.queries()[name](spark, DATA), duck, catalogue.oracle_sql()[name])


def test_hits_of_the_tables_agree_with_their_texts(spark):
    """The one query without SQL (see test_seeds for its scores): alignments are of the texts that they name."""
    from spanforge.plans import projections as P

    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == {"q49_extended_hits"}
    subjects = {str(r.id): r.seq for r in P.sequences(spark, DATA).collect()}
    hits = catalogue.q49_extended_hits(spark, DATA).collect()
    assert all(r.sseq.replace("-", "") == subjects[r.seqid][r.start1 - 1 : r.end1] and len(r.qseq) == len(r.sseq) == r.alignment_length for r in hits)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
