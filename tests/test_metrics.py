from medlattice.operators import metrics


def test_purity_and_confusion(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (1, 2), (1, 3), (2, 3)], "cluster int, label int")
    p = metrics.purity(df).first()
    assert abs(p.purity - 4 / 6) < 1e-12 and p.n == 6
    assert 1 / 3 <= p.purity <= 1
    cm = {(r.truth, r.prediction): r.fraction
          for r in metrics.confusion_matrix(df, truth="label", prediction="cluster").collect()}
    assert cm[(1, 0)] == 1.0 and cm[(2, 0)] == 0.5 and cm[(3, 2)] == 0.5


def test_binary_metrics_against_hand_computation(spark):
    rows = [(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (0, 0, 0.1), (1, 1, 0.6), (0, 0, 0.4)]
    df = spark.createDataFrame(rows, "label int, prediction int, score double")
    m = metrics.binary_metrics(df, "label", "prediction", "score").first()
    assert abs(m.accuracy - 4 / 6) < 1e-12
    assert abs(m.precision - 2 / 3) < 1e-12 and abs(m.recall - 2 / 3) < 1e-12
    pos = [0.9, 0.4, 0.6]
    neg = [0.6, 0.1, 0.4]
    u = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / 9
    assert abs(m.auc - u) < 1e-12
    # average precision by thresholds 0.9, 0.6, 0.4
    ap = (1 / 3) * 1.0 + (1 / 3) * (2 / 3) + (1 / 3) * (3 / 5)
    assert abs(m.average_precision - ap) < 1e-12
    curve = sorted((r.fpr, r.tpr) for r in metrics.roc_curve(df, "label", "score").collect())
    assert curve[-1] == (1.0, 1.0)


def test_means(spark):
    df = spark.createDataFrame([(0.5, 2), (1.0, 2)], "v double, n int")
    assert metrics.weighted_mean(df, "v", "n").first()[0] == 0.75
    assert metrics.fold_mean(df, "v").first()[0] == 0.75
    acc = spark.createDataFrame([(1, 1), (2, 1)], "label int, prediction int")
    assert metrics.multiclass_accuracy(acc).first()[0] == 50.0
