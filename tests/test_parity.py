"""Every query with SQL must agree with it."""

from __future__ import annotations

import pytest

from fleetlens.catalog import all_queries, all_sql
from tests.parity import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_only_fitted_models_lack_sql():
    assert set(all_queries()) - set(all_sql()) == {
        "train_logistic", "train_forest", "train_gbt", "feature_importance", "batch_scores", "ml_pipeline",
        "champion_scores", "champion_scores_none",
    }


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_agrees_with_sql(spark, duck, name):
    rows, problems = differences(spark, FOLDER, all_queries()[name], all_sql()[name], duck)
    assert rows > 0 or name == "top_drifted"
    assert not problems
