"""Every query with an SQL counterpart gives the same rows, names and types as it."""

import pytest

from tidecast.functions.scoring import ASPECTS, POLARITIES
from tidecast.plans import catalog, oracle
from tidecast.plans.oracle import with_views

STATEMENTS = oracle.statements()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


#: Fits that SQL can not express; ``test_models`` and ``test_boosting`` hold them against brute force.
FITTED = {
    "train_predict", "top_features", "cv_predictions", "random_search", "evaluate_model", "forecast_day",
    "text_relevance", "relevance_filter", "text_polarity", "network_relevance", "network_polarity",
}


def test_every_query_has_a_counterpart():
    assert set(catalog.QUERIES) == set(STATEMENTS) | FITTED | {"encode_subwords"} and not FITTED & set(STATEMENTS)


@pytest.mark.parametrize("name", STATEMENTS)
def test_same_result(name, spark, sf_dir, duck):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    cursor = duck.execute(STATEMENTS[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert sorted(types) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(FITTED))
def test_fitted_results_are_whole(name, spark, sf_dir, duck):
    """Every row that the query is about is there once, classes follow from chances, scores from stored predictions."""
    rows = [r.asDict() for r in catalog.QUERIES[name](spark, sf_dir).collect()]
    series = duck.execute(with_views("SELECT series_id, max(date) FROM fx_features GROUP BY ALL")).fetchall()
    docs = [r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall()]
    if name == "train_predict":
        assert sorted((r["series_id"], r["date"]) for r in rows) == sorted(series)
        assert all(r["prediction"] == ("Up" if r["p"] > 0.5 else "Down") for r in rows) and len({r["p"] for r in rows}) > 2
    elif name == "top_features":
        assert [r["position"] for r in sorted(rows, key=lambda r: r["position"])] == list(range(1, 11))
        assert 0.9 < sum(r["importance"] for r in rows) <= 1 + 1e-9 and len({r["feature"] for r in rows}) == 10
    elif name == "cv_predictions":
        expected = duck.execute(with_views("""
            SELECT series_id, date, CAST((date - start) // 7 AS BIGINT), is_price_up
            FROM fx_features, (SELECT min(date) + 14 AS start FROM fx_features) WHERE date >= start""")).fetchall()
        assert sorted((r["series_id"], r["date"], r["fold_id"], r["is_price_up"]) for r in rows) == sorted(expected)
        assert all(0 < r["p"] < 1 for r in rows) and len({r["p"] for r in rows}) > 2
    elif name == "random_search":
        assert [r["trial"] for r in sorted(rows, key=lambda r: r["trial"])] == list(range(len(catalog.SEARCH)))
        assert all(0 < r["macro_f1"] <= 1 for r in rows)
    elif name in ("evaluate_model", "forecast_day"):
        assert sorted(r["series_id"] for r in rows) == sorted(s for s, _ in series)
        assert all(r[c] is None or 0 <= r[c] <= 1 for r in rows for c in ("eval_acc", "holdout_eval_acc"))
        assert sum(r["eval_acc"] is not None for r in rows) > 0.9 * len(rows)
    elif name in ("text_relevance", "network_relevance"):
        labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
        assert sorted(r["doc_id"] for r in rows) == sorted(docs)
        assert all(r["prediction"] == (r["p_relevant"] > 0.5) for r in rows)
        assert sum(labels[r["doc_id"]] == r["prediction"] for r in rows if r["doc_id"] in labels) > 0.9 * len(labels)
    elif name == "relevance_filter":
        scored = catalog.QUERIES["text_relevance"](spark, sf_dir).where("prediction = 1").collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in scored)
    else:
        assert sorted((r["doc_id"], r["aspect"]) for r in rows) == sorted((k, a) for k in docs for a in ASPECTS)
        assert {r["polarity"] for r in rows} <= set(POLARITIES) and len({r["polarity"] for r in rows}) > 1
