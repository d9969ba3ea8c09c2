"""The registered forest and forecast queries return what their models predict."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from quarry.plans import learning


@pytest.mark.parametrize("query,model", [("rf_regression", "_forest"), ("ar_forecast", "_forecast")])
def test_returned_values_are_the_models(spark, monkeypatch, query, model):
    real = getattr(learning, model)(spark, SF_ORACLE)
    monkeypatch.setattr(learning, model, lambda *a: real.withColumn("prediction", F.col("prediction") + 1000))
    moved = getattr(learning, query)(spark, SF_ORACLE).agg(F.avg("prediction")).first()[0]
    monkeypatch.undo()
    assert moved == pytest.approx(getattr(learning, query)(spark, SF_ORACLE).agg(F.avg("prediction")).first()[0] + 1000, rel=1e-6)


def test_rows_of_the_models(spark):
    for query, model, key, label in (("rf_predictions", "_forest", ["Date"], "Close"),
                                     ("ar_predictions", "_forecast", ["user_id", "ts", "event_id"], "target")):
        got = getattr(learning, query)(spark, SF_ORACLE).select(*key, label, "prediction").collect()
        want = getattr(learning, model)(spark, SF_ORACLE).select(*key, label, "prediction").collect()
        want = {tuple(r)[:-1]: r.prediction for r in want}
        assert len(got) == len(want) > 0 and len({r.prediction for r in got}) > 10
        assert all(r.prediction == pytest.approx(want[tuple(r)[:-1]], abs=1e-4) for r in got)


def test_forecast_scores(spark):
    got = learning.forecast_metrics(spark, SF_ORACLE).first()
    rows = learning._forecast(spark, SF_ORACLE).select("target", "prediction").collect()
    n, mean = len(rows), sum(r.target for r in rows) / len(rows)
    sse = sum((r.target - r.prediction) ** 2 for r in rows)
    r2 = 1 - sse / sum((r.target - mean) ** 2 for r in rows)
    assert got.n == n and got.mse == pytest.approx(sse / n) and got.r2 == pytest.approx(r2)
    assert got.r2adj == pytest.approx(1 - (1 - r2) * (n - 1) / (n - learning.HISTORY - 1))
