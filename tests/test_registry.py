"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as registered
import oracle_check
import registry.queries
from registry.oracles import ORACLES
from registry.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF)


@pytest.fixture(scope="module", autouse=True)
def fits_once():
    """Queries that show parts of one fit share it here; each makes it for itself outside tests."""
    known, patch = {}, pytest.MonkeyPatch()

    def once(make):
        def found(*args, **options):
            key = (make.__name__, *sorted(options.items()))
            if key not in known:
                known[key] = make(*args, **options)
            return known[key]

        return found

    patch.setattr(registry.queries, "_clusters", once(registry.queries._clusters))
    patch.setattr(registry.queries.factorize, "als_factors", once(registry.queries.factorize.als_factors))
    fit_tree = once(registry.queries.tree.fit_tree)
    patch.setattr(registry.queries.tree, "fit_tree", fit_tree)
    patch.setattr(registry.queries.classify, "fit_tree", fit_tree)
    yield
    patch.undo()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, con, name):
    df = registered.queries()[name](spark, SF)
    assert oracle_check.difference(df, con, registered.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_has_rows(spark, name):
    assert registered.queries()[name](spark, SF).count() > 0


def test_flagship_has_rows(spark):
    assert registered.entry(spark).columns == ["target", "rank", "candidate", "n"]
