from pyspark.sql import functions as F

from sluice.operators import models as ML


def test_a_grid_of_one_point_is_fitted_once(spark, monkeypatch):
    made, real = [], ML.GBTClassifier._fit
    monkeypatch.setattr(ML.GBTClassifier, "_fit", lambda self, data: made.append(data.count()) or real(self, data))
    x = spark.range(4000).select((F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b")).withColumn("y", (F.col("a") > 20).cast("int"))
    model = ML.train_classifier(x, ["a", "b"], "y", depths=(2,), iterations=(2,), folds=2)
    assert len(made) == 1 and model.transform(x).where("prediction <> y").count() < 400
    ML.train_classifier(x, ["a", "b"], "y", depths=(1, 2), iterations=(2,), folds=2)
    assert len(made) == 6
