"""Every registered query against its SQL over the same tables."""

import pytest

import __spark_entry__ as entry
from flowlake.plans.oracles import ORACLES
from flowlake.plans.queries import REGISTRY
from tests.parity import compare, duck

SMALL = "/root/testdata/sf0.001"
# The smallest tables hold no alert of these kinds.
LARGER = dict.fromkeys(("fan_in_alerts", "fan_out_alerts", "syn_burst_alerts"),
                       "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def databases():
    return {path: duck(path) for path in {SMALL, *LARGER.values()}}


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, databases, name):
    sf_dir = LARGER.get(name, SMALL)
    df = entry.queries()[name](spark, sf_dir)
    assert compare(df, databases[sf_dir], entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n.startswith("streaming_")))
def test_streams_do_not_follow_the_zone_of_the_session(spark, databases, name):
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    df = REGISTRY[name](session, SMALL)
    assert compare(df, databases[SMALL], ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 3
