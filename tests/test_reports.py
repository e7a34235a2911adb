"""Raw CSV tables, missing-first codes, packed vectors, best-model gate."""

import uuid

from rebuy.operators import encoders as E
from rebuy.operators import metrics as K
from rebuy.operators import quality as Q
from rebuy.session import shared_path
from rebuy.sources import io as IO


def test_csv_tables_keep_lines_and_quotes(spark):
    rows = [(1, 'two\nlines, "quoted"'), (2, " spaced "), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    path = shared_path(spark, f"csv-{uuid.uuid4().hex}")
    IO.write_csv(df, path)
    back = IO.load_tables(spark, {"t": path}, {"t": df.schema})["t"]
    assert {r.id: r.text for r in back.collect()} == {1: rows[0][1], 2: " spaced ", 3: None, 4: None}


def test_missing_is_a_category_and_unseen_is_zero(spark):
    train = spark.createDataFrame([("b",), (None,), ("A",), ("b",)], "c string")
    codes = E.fit_ordinal(train, "c", E.MISSING)
    assert {r.value: r.code for r in codes.collect()} == {"A": 0, E.MISSING: 1, "b": 2}
    test = spark.createDataFrame([("b",), (None,), ("new",)], "c string")
    got = E.ordinal_encode(test, "c", codes, unknown=0, missing=E.MISSING)
    assert {r.c: r.c_code for r in got.collect()} == {"b": 2, None: 1, "new": 0}
    got = E.ordinal_encode(test, "c", E.fit_ordinal(train, "c"))
    assert {r.c: r.c_code for r in got.collect()} == {"b": 1, None: -1, "new": -1}


def test_packed_vectors(spark):
    df = spark.createDataFrame([(1,), (2,)], "order_id long")
    w = spark.createDataFrame([(1, 5, 0.5), (1, 2, 0.25)], "order_id long, index long, weight double")
    got = {r.order_id: r.text_features for r in E.tfidf_vectors(df, w, 7).collect()}
    assert got[1].size == 7 and got[1].indices.tolist() == [2, 5] and got[1].values.tolist() == [0.25, 0.5]
    assert got[2].size == 7 and not len(got[2].indices)


def test_best_model_summary_and_gate(spark):
    cols = ["model", "split", *K.METRICS]
    rows = [("a", "val", *[0.5] * 8), ("b", "val", *[0.6] * 8), ("a", "test", *[0.4] * 8), ("b", "test", *[0.3] * 8)]
    best = K.best_model_summary(spark.createDataFrame(rows, cols))
    r = best.first()
    assert (r.overall_validation_best_model, r.overall_test_best_model, r.recommended_model) == ("b", "a", "b")
    assert r.recommended_model_test_metrics.pr_auc == 0.3 and r.n_total_models_evaluated == 2
    assert Q.best_model_gate(best).first().passed == 1
    assert Q.best_model_gate(best.drop("recommendation_reason")).first().passed == 0
    assert Q.best_model_gate(best.limit(0)).first().passed == 0
