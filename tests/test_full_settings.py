"""Model queries run with the settings and classes of the models they replace."""

import pytest

from flowscore.plans import catalog

SF = "/root/testdata/sf0.001"


class Asked(Exception):
    pass


def asked(monkeypatch, spark, query):
    """(training rows, label column, options) the query gives to the fit, which is not run."""

    def fit(train, label, *rest, **options):
        raise Asked(train, label, options)

    monkeypatch.setattr(catalog, "fit_classifier", fit)
    with pytest.raises(Asked) as found:
        query(spark, SF)
    return found.value.args


def test_ten_classes_and_all_rounds(spark, monkeypatch):
    train, label, options = asked(monkeypatch, spark, catalog.train_gbt_ovr)
    assert options["kind"] == "softmax" and options["params"] == {"rounds": 100, "depth": 6}
    assert train.select(label).distinct().count() == 10


def test_boosted_trees_have_all_rounds(spark, monkeypatch):
    _, _, options = asked(monkeypatch, spark, catalog.train_gbt)
    assert options["kind"] == "gbt" and options["params"] == {"maxIter": 100, "maxDepth": 6}
