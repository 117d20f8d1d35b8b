from pyspark.sql import functions as F

from staylens.catalogue import models_and_features
from staylens.catalogue.models_and_features import FEATURES
from staylens.catalogue.registry import QUERIES, Inputs


def test_registered_boosting_learns(spark, monkeypatch):
    """Prices that follow two features: the held-out error is a small part of the mean's."""
    x, y = F.col("id") * 37 % 101 / 101, F.col("id") * 53 % 97 / 97
    listing = spark.range(600).coalesce(1).select(
        "id", x.alias(FEATURES[0]), y.alias(FEATURES[1]),
        *[F.lit(0.0).alias(n) for n in FEATURES[2:]],
    )
    price = f"exp(3 + sin(9 * {FEATURES[0]}) + sin(12 * {FEATURES[1]}))"
    monkeypatch.setattr(models_and_features, "PRICE", price)
    monkeypatch.setattr(Inputs, "listing", lambda self, *names: listing.select(*names))
    rows = QUERIES["M8_boosted_predictions"](spark, "").collect()
    mean = sum(r["label"] for r in rows) / len(rows)
    own = sum((r["label"] - r["prediction"]) ** 2 for r in rows)
    plain = sum((r["label"] - mean) ** 2 for r in rows)
    assert own < 0.1 * plain, (own, plain)
