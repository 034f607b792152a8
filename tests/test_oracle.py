"""Every registered query equals its DuckDB oracle (sf0.001), or at least runs."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import canon, duck

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        # only the queries that SQL can't express (tested against brute force in tests/llm) have no oracle
        assert name in E.LLM and len(got.columns) > 0
        return
    want = con.execute(sql).fetchdf()
    gc, gr = canon(got)
    wc, wr = canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_fixed_batches_do_not_depend_on_files(spark, con, tmp_path):
    """The table as a directory of parts gives the batches of the oracle."""
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    got = E.queries()["stream_fixed_batches"](spark, str(tmp_path)).toPandas()
    assert canon(got) == canon(con.execute(E.oracle_sql()["stream_fixed_batches"]).fetchdf())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["batch_idx", "num_sequences", "num_tokens", "num_loss_tokens"]
    assert df.count() >= 0
