"""Risk-model plumbing on the smallest driver tables with a tiny forest."""

import os
import tempfile

from pyspark.sql import functions as F

from skyhealth.functions.constants import PROB_COLUMNS
from skyhealth.ml import risk_model as R
from skyhealth.plans import q_ml
from skyhealth.plans.daily import gold_features
from skyhealth.session import cut_lineage


def test_train_save_load_score(spark, sf_small):
    gold = cut_lineage(gold_features(spark, sf_small))
    features = R.select_features(gold)
    assert len(features) == 17            # 13 base + 4 optional present in the gold table
    model, feats, rows = R.train(gold, num_trees=3, max_depth=4)
    # stratified split: every class is present on both sides when it has enough rows
    split = rows.groupBy("health_category").agg(F.count_if("is_test").alias("t"),
                                                F.count_if(~F.col("is_test")).alias("r")).collect()
    assert all(r.r > 0 for r in split)
    path = os.path.join(tempfile.mkdtemp(prefix="skyhealth-model-"), "model")
    R.save_model(model, path)
    loaded = R.load_model(path)
    a = R.score(model, gold.drop("health_category"), feats).select("site_id", "date",
                                                                    "predicted_category", "confidence")
    b = R.score(loaded, gold.drop("health_category"), feats).select("site_id", "date",
                                                                     "predicted_category", "confidence")
    assert a.exceptAll(b).count() == 0
    scored = R.score(model, gold.drop("health_category"), feats)
    row = scored.select(*PROB_COLUMNS.values(), "confidence").first()
    assert abs(sum(row[c] for c in PROB_COLUMNS.values()) - 1.0) < 1e-3
    assert row.confidence == max(row[c] for c in PROB_COLUMNS.values())


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "health_category string")
    w = {r.health_category: r.weight for r in R.class_weights(df).collect()}
    assert w == {"a": 8 / (2 * 6), "b": 8 / (2 * 2)}


def test_changed_files_are_another_model_input(spark, sf_small, tmp_path):
    for t in ("lineitem", "orders"):
        spark.read.parquet(f"{sf_small}/{t}.parquet").limit(5).write.parquet(f"{tmp_path}/{t}.parquet")
    before = q_ml._inputs(spark, str(tmp_path))
    assert q_ml._inputs(spark, f"{tmp_path}/") == before
    spark.read.parquet(f"{sf_small}/orders.parquet").limit(9).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert q_ml._inputs(spark, str(tmp_path)) != before


def _saved_forest(spark, path):
    """The trees, labels and scaled features of a saved pipeline, as plain data."""
    stage = {name.split("_")[1]: os.path.join(path, "stages", name) for name in os.listdir(os.path.join(path, "stages"))}
    trees = {}
    for r in spark.read.parquet(f"{stage['RandomForestClassifier']}/data").collect():
        trees.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData
    return list(trees.values())


def _walk(tree, x):
    node = tree[0]
    while node.leftChild >= 0:
        s = node.split
        assert s.numCategories < 0                       # all features are numbers
        node = tree[node.leftChild if x[s.featureIndex] <= s.leftCategoriesOrThreshold[0] else node.rightChild]
    return node.impurityStats


def test_scores_are_those_of_the_saved_trees(spark, sf_small):
    """Label and probabilities of every scored row against a walk of the saved
    trees in plain Python: each tree votes with its leaf's class shares."""
    gold = cut_lineage(gold_features(spark, sf_small))
    model, feats, _ = R.train(gold, num_trees=7, max_depth=6)
    path = os.path.join(tempfile.mkdtemp(prefix="skyhealth-model-"), "model")
    R.save_model(model, path)
    trees, labels = _saved_forest(spark, path), R.labels_of(model)
    assert len(trees) == 7
    rows = R.score(R.load_model(path), gold.drop("health_category"), feats).collect()
    assert len(rows) == gold.count()
    for r in rows:
        x = [r[f] or 0.0 for f in feats]
        votes = [0.0] * len(labels)
        for stats in (_walk(t, x) for t in trees):
            for i in range(len(labels)):
                votes[i] += stats[i] / sum(stats)
        share = [v / sum(votes) for v in votes]
        best = max(share)
        assert r.predicted_category in {c for c, p in zip(labels, share) if abs(p - best) < 1e-9}
        assert abs(r.confidence - best) <= 5.1e-5
        for c, p in zip(labels, share):
            if c in PROB_COLUMNS:
                assert abs(r[PROB_COLUMNS[c]] - p) <= 5.1e-5


def test_labels_follow_the_features(spark, sf_small):
    """With every feature of another day the labels change; trained on shuffled
    labels the forest fails the margin that it has with the real ones."""
    gold = cut_lineage(gold_features(spark, sf_small))
    model, feats, rows = R.train(gold, num_trees=10, max_depth=8)
    held = rows.where("is_test")
    assert q_ml.holdout_margin(R.score(model, held, feats)).first().beats_majority
    opposite = gold.select("site_id", "date", *[(-F.col(c) + F.lit(100.0)).alias(c) for c in feats])
    own = R.score(model, gold.drop("health_category"), feats).select("site_id", "date", "predicted_category")
    other = R.score(model, opposite, feats).select("site_id", "date", F.col("predicted_category").alias("other"))
    changed = own.join(other, ["site_id", "date"]).where("predicted_category <> other").count()
    assert changed > gold.count() / 4
    order = gold.selectExpr("site_id", "date", "row_number() OVER (ORDER BY xxhash64(site_id, date, 3)) AS i")
    labels = gold.selectExpr("health_category", "row_number() OVER (ORDER BY xxhash64(date, site_id, 5)) AS i")
    shuffled = cut_lineage(gold.drop("health_category").join(order, ["site_id", "date"]).join(labels, "i").drop("i"))
    model, feats, rows = R.train(shuffled, num_trees=10, max_depth=8)
    assert not q_ml.holdout_margin(R.score(model, rows.where("is_test"), feats)).first().beats_majority
