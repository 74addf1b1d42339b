"""Each registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
import checks.queries
from checks.compare import connect, difference

SF = "/root/testdata/sf0.001"
MODELS = ("train_", "tune_", "feature_importances")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_twin(merged, duck, name):
    mine = contract.queries()[name](merged, SF).toPandas()
    assert difference(mine, duck.execute(contract.oracle_sql()[name]).df()) is None


@pytest.mark.parametrize(
    "name", sorted(n for n in set(contract.queries()) - set(contract.oracle_sql()) if not n.startswith(MODELS))
)
def test_query_without_twin_has_rows(merged, name):
    assert contract.queries()[name](merged, SF).count() > 0


def test_comment_batches_hold_all_turns(merged):
    turns = merged.read.parquet(f"{SF}/conversations.parquet").count()
    for name in ("comment_batches", "comment_summaries"):
        assert contract.queries()[name](merged, SF).agg({"n": "sum"}).first()[0] == turns


@pytest.mark.parametrize("name", ["train_classifier", "train_regressor", "train_ranker", "tune_ranker"])
def test_model_queries_run_the_whole_job(merged, monkeypatch, name):
    given = {}

    class Reached(Exception):
        pass

    def stop(*args, **options):
        given.update(options)
        raise Reached

    monkeypatch.setattr(checks.queries.training, name, stop)
    with pytest.raises(Reached):
        contract.queries()[name](merged, SF)
    assert not {"trials", "folds", "maxIter", "maxDepth", "numTrees"} & set(given)


def test_flagship(merged):
    rows = contract.entry(merged)
    assert rows.columns[:3] == ["asin", "site", "dt"] and rows.count() > 0


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
