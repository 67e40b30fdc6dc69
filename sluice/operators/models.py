"""Models and their evaluation on Spark ML (FE02, FE03, ML, ST02 operators)."""

from __future__ import annotations

import gc

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.functions.expressions import clear_names, safe_ratio
from sluice.operators.products import best_products
from sluice.operators.ranks import curve_areas
from sluice.operators.similarity import similar_sets
from sluice.sources.tables import stored


#: Rows that a task of a fit goes over at most, about.
TASK_ROWS = 250_000
#: Ratings of a block of factors' fits, about, where there are more than ten blocks hold by default.
BLOCK_RATINGS = 8_000_000


def encode(df: DataFrame, columns: list[str]) -> tuple[DataFrame, PipelineModel]:
    """FE02: <c>_index by descending frequency, ties alphabetical, and <c>_onehot; unknown and null values get the last index."""
    model = encode_fit(df, columns)
    return model.transform(df), model


def encode_fit(df: DataFrame, columns: list[str]) -> PipelineModel:
    """FE02: the encoding alone, for frames other than the one that it is learned from."""
    stages = [StringIndexer(inputCols=columns, outputCols=[f"{c}_index" for c in columns], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_onehot" for c in columns])]
    return Pipeline(stages=stages).fit(df)


def assemble_scaled(columns: list[str]) -> Pipeline:
    """FE03: a vector of the columns, standardised by mean and deviation."""
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="skip"), StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)])


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """FE03 as columns: (x - mean) / deviation, 0 where the deviation is 0. One aggregate, joined as one row."""
    one = df.agg(*(f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev))))
    out = df.join(F.broadcast(one)).withColumns({f"{c}_scaled": F.coalesce(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")), F.lit(0.0)) for c in columns})
    return out.drop(*(f"_{n}_{c}" for c in columns for n in "ms"))


def train_classifier(train: DataFrame, features: list[str], label: str, depths: tuple[int, ...] = (3, 5), iterations: tuple[int, ...] = (10,), steps: tuple[float, ...] = (0.1,), folds: int = 3, seed: int = 42) -> PipelineModel:
    """ML01: gradient-boosted trees, cross-validated on the area under the ROC curve. Each row is dealt to a fold; rows equal in fold, label
    and features are then one row whose weight is their number, which is the same to trees and areas, and the fits go over these. A grid
    of one point leaves nothing to choose: it is fitted once, on all rows, without folds."""
    weight, fold = clear_names(train, "weight", "fold")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", weightCol=weight, seed=seed)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, depths).addGrid(gbt.maxIter, iterations).addGrid(gbt.stepSize, steps).build()
    prepared = assemble_scaled(features).fit(train)
    number = F.floor(F.rand(seed) * folds).cast("int") if len(grid) > 1 else F.lit(0)
    dealt = train.select(label, *features, number.alias(fold))
    data = dealt.groupBy(label, *features, fold).agg(F.count(F.lit(1)).cast("double").alias(weight))
    kept = prepared.transform(data).select(label, "features", weight, fold).persist()
    try:
        n, now, cores = kept.count(), kept.rdd.getNumPartitions(), train.sparkSession.sparkContext.defaultParallelism
        parts = max(-(-n // TASK_ROWS), min(cores, -(-n // 20_000)), 1)
        data = kept.coalesce(parts) if parts < now else kept.repartition(parts)
        if len(grid) == 1:
            return PipelineModel([*prepared.stages, gbt.fit(data, grid[0])])
        evaluator = BinaryClassificationEvaluator(labelCol=label, weightCol=weight)
        cv = CrossValidator(estimator=gbt, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, parallelism=2, seed=seed, foldCol=fold).fit(data)
    finally:
        kept.unpersist()
    return PipelineModel([*prepared.stages, cv.bestModel])


def train_forest(train: DataFrame, features: list[str], label: str, trees: int = 20, depth: int = 5, seed: int = 42) -> PipelineModel:
    """ML12"""
    return Pipeline(stages=[*assemble_scaled(features).getStages(), RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)]).fit(train)


def score(df: DataFrame, model: Transformer, key: str) -> DataFrame:
    """ML10: (key, probability of 1, prediction)."""
    return model.transform(df).select(key, vector_to_array("probability")[1].alias("p"), "prediction")


def ensemble(scored: list[DataFrame], key: str) -> DataFrame:
    """ML12: the mean probability of several scored frames."""
    out = scored[0].select(key, F.col("p").alias("_p0"))
    for k, s in enumerate(scored[1:], 1):
        out = out.join(s.select(key, F.col("p").alias(f"_p{k}")), key)
    return out.select(key, (sum(F.col(f"_p{k}") for k in range(len(scored))) / len(scored)).alias("p"))


def score_all(df: DataFrame, models: dict[str, Transformer], keep: list[str], mean: str | None = "ensemble") -> DataFrame:
    """ML10, ML12: keep..., and the probability of 1 by each model under its name, and their mean. The models go over the same rows one
    after the other; nothing is joined, so rows need no key."""
    made = ["raw_features", "features", "rawPrediction", "probability", "prediction"]
    out = df
    for name, m in models.items():
        out = m.transform(out).withColumn(name, vector_to_array("probability")[1]).drop(*made)
    return out.select(*keep, *models, *([(sum(F.col(n) for n in models) / len(models)).alias(mean)] if mean else []))


def save(model: PipelineModel, path: str) -> None:
    """SNK06"""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel, features: list[str]) -> DataFrame:
    """ML09: (feature, importance) of a tree model, largest first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return SparkSession.active().createDataFrame(list(zip(features, values, strict=True)), "feature string, importance double").orderBy(F.desc("importance"), "feature")


def confusion(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """ML06, AG11: one row of counts and ratios, 0 where undefined; one aggregate."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    one = predictions.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))
    d = {c: F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn")}
    out = one.withColumns({"precision": safe_ratio(d["tp"], d["tp"] + d["fp"]), "recall": safe_ratio(d["tp"], d["tp"] + d["fn"]), "accuracy": safe_ratio(d["tp"] + d["tn"], d["tp"] + d["fp"] + d["tn"] + d["fn"]), "specificity": safe_ratio(d["tn"], d["tn"] + d["fp"])})
    return out.withColumn("f1", safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def auc(predictions: DataFrame, label: str, value: str) -> DataFrame:
    """ML06: one row: the area under the ROC curve, ties counted half."""
    return curve_areas(predictions, label, value).select("auc")


def area_under_pr(predictions: DataFrame, label: str, raw: str) -> float:
    """ML06: by Spark ML's evaluator."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderPR").evaluate(predictions)


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """ML07"""
    e = F.col(prediction) - F.col(label)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def performance(predictions: DataFrame, actuals: DataFrame, key: str, label: str, prediction: str, threshold: float) -> DataFrame:
    """DR09: confusion() of the joined rows, and degraded: accuracy below the threshold."""
    return confusion(predictions.join(actuals, key), label, prediction).withColumn("degraded", F.col("accuracy") < threshold)


def train_als(ratings: DataFrame, user: str, item: str, rating: str, ranks: tuple[int, ...] = (5,), regs: tuple[float, ...] = (0.1,), iterations: int | tuple[int, ...] = 3, folds: int = 2, seed: int = 42) -> ALSModel:
    """ML02: non-negative factors, unknown ids dropped; cross-validated over ranks, regularisations and iterations where there is a
    choice, one fit after the other, so that the disk holds what one of them shuffles. Ids are integers."""
    blocks = max(10, -(-ratings.count() // BLOCK_RATINGS))
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, nonnegative=True, coldStartStrategy="drop", seed=seed, numUserBlocks=blocks, numItemBlocks=blocks)
    if ratings.sparkSession.sparkContext.getCheckpointDir():
        als.setCheckpointInterval(1)  # the shuffles before a checkpoint are deleted, which a fit otherwise keeps to its end
    steps = (iterations,) if isinstance(iterations, int) else iterations
    if len(ranks) * len(regs) * len(steps) == 1:
        return als.setRank(ranks[0]).setRegParam(regs[0]).setMaxIter(steps[0]).fit(ratings)
    grid = ParamGridBuilder().addGrid(als.rank, ranks).addGrid(als.regParam, regs).addGrid(als.maxIter, steps).build()
    (fold,) = clear_names(ratings, "fold")
    dealt = stored(ratings.select(user, item, rating, F.floor(F.rand(seed) * folds).cast("int").alias(fold)), "folds")
    evaluator, errors = RegressionEvaluator(labelCol=rating), []
    for point in grid:
        of_folds = []
        for k in range(folds):
            model = als.fit(dealt.where(F.col(fold) != k), point)
            of_folds.append(evaluator.evaluate(model.transform(dealt.where(F.col(fold) == k))))
            del model
            _forget(dealt.sparkSession)
        errors.append(sum(of_folds) / folds)
    return als.fit(dealt, grid[errors.index(min(errors))])


def _forget(spark: SparkSession) -> None:
    """Lets Spark delete the shuffles and blocks of frames that are out of use, which it does when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def recommend(model: ALSModel, user: str, item: str, n: int, as_of: str) -> DataFrame:
    """ML03, ST02, PRJ11: (user, item, rating, rank, generated_at): the n best items of every user; of equal ratings the smaller item
    comes first. recommendForAllUsers() compares every user with every item; here cells of items that can't be among the best are left out."""
    best = best_products(model.userFactors, model.itemFactors, n)
    return best.select(F.col("query").alias(user), F.col("item").alias(item), F.col("product").cast("float").alias("rating"), "rank", F.lit(as_of).cast("timestamp").alias("generated_at"))


def top_users(model: ALSModel, user: str, item: str, n: int) -> DataFrame:
    """ML04: (item, rank, user, rating): the n best users of every item, by rating and user."""
    best = best_products(model.itemFactors, model.userFactors, n)
    return best.select(F.col("query").alias(item), "rank", F.col("item").alias(user), F.col("product").cast("float").alias("rating"))


def similar_items(ratings: DataFrame, user: str, item: str, least: float = 0.7, least_common: int = 1, block_items: int = 1000) -> DataFrame:
    """ML04: (item_a, item_b, common, similarity): cosine of the items' sets of users, item_a < item_b, exact."""
    pairs = similar_sets(ratings, item, user, least, "cosine", block_items)
    return pairs.where(F.col("common") >= least_common).withColumnsRenamed({"a": "item_a", "b": "item_b"})


def content_similarity(items: DataFrame, item: str, attributes: list[str], least: float = 0.7) -> DataFrame:
    """ML13: (class_a, class_b, similarity), both ways and with themselves: Jaccard of the items' attributes. Items with equal
    attributes are one class, and only classes are compared; pairs of items are made from pairs of classes."""
    classes = items.groupBy(*attributes).agg(F.min(item).alias("c"))
    marks = classes.select("c", F.explode(F.array(*(F.concat(F.lit(f"{a}="), F.col(a).cast("string")) for a in attributes))).alias("m")).where("m is not null")
    pairs = similar_sets(marks, "c", "m", least, "jaccard").select("a", "b", "similarity")
    own = marks.select(F.col("c").alias("a"), F.col("c").alias("b"), F.lit(1.0).alias("similarity")).distinct()
    every = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity")).unionByName(own)
    return every.withColumnsRenamed({"a": "class_a", "b": "class_b"})


def attribute_class(items: DataFrame, item: str, attributes: list[str]) -> DataFrame:
    """ML13: (item, class): the classes that content_similarity() compares."""
    return items.select(item, F.min(item).over(Window.partitionBy(*attributes)).alias("class"))


def hybrid(predicted: DataFrame, content: DataFrame, keys: list[str], weight: float = 0.5) -> DataFrame:
    """ML13: weight * predicted rating + (1 - weight) * content score; a missing side counts as 0."""
    out = predicted.join(content, keys, "full").fillna(0.0, ["rating", "content_score"])
    return out.withColumn("hybrid_score", F.col("rating") * weight + F.col("content_score") * (1 - weight))


def recommendation_metrics(recs: DataFrame, test: DataFrame, user: str, item: str, rating: str, least: float = 4.0) -> DataFrame:
    """ML08, JN06: one row: coverage of users and items, recommendations per user, precision."""
    per_user = recs.groupBy(user).agg(F.count(F.lit(1)).alias("n"))
    relevant = test.where(F.col(rating) >= least).select(user, item).distinct()
    hits = recs.select(user, item).join(relevant, [user, item], "left_semi").agg(F.count(F.lit(1)).alias("hits"))
    users = test.select(user).distinct()
    items = test.select(item).distinct()
    one = per_user.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("recs"), F.avg("n").alias("avg_per_user"))
    seen = lambda of, c, n: of.join(recs.select(c).distinct(), c, "left_semi").agg(F.count(F.lit(1)).alias(n))
    every = one.join(hits).join(seen(users, user, "u")).join(seen(items, item, "i")).join(users.agg(F.count(F.lit(1)).alias("nu"))).join(items.agg(F.count(F.lit(1)).alias("ni")))
    return every.select((F.col("u") / F.col("nu")).alias("user_coverage"), (F.col("i") / F.col("ni")).alias("item_coverage"), "avg_per_user", F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("recs")), F.lit(0.0)).alias("precision"))


def cluster(df: DataFrame, features: list[str], k: int = 50, seed: int = 42) -> DataFrame:
    """ML05"""
    data = VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="skip").transform(df)
    return KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(data).transform(data).drop("_v")


def run_summary(df: DataFrame, label: str) -> DataFrame:
    """ML11: one row of counts and the share of ones."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(label) == 1).alias("n_positive"), F.avg(F.col(label).cast("double")).alias("positive_rate"))
