"""Every numbered query through the explorer equals the registered body."""

import uuid

import pytest

from qalake import adapter, registry
from qalake.explorer import ANALYTICS, run_query
from qalake.operators.derive import post_tags
from qalake.session import scratch_path

from conftest import SF_SMALL

P = {"me": registry.ME}
PARAMS = {"q01": P, "q02": P, "q03": P, "q04": P, "q05": P, "q06": P, "q07": P, "q14": P,
          "q08": {"me": registry.ME, "rival": registry.RIVAL},
          "q18": {"start": registry.MONTH_START, "end": registry.MONTH_END},
          "q22": {"percent": 10}, "q23": {"min_zero": 1}, "q24": {"badge": "Guru"},
          "q30": {"me": registry.VANITY_ME, "months": 2}, "q34": {"min_self": 0}}
KEYS = {k.split("_")[0]: k for k in registry.bodies() if k.startswith("q")}


@pytest.fixture(scope="module")
def site(spark):
    qa = adapter.load(spark, SF_SMALL)
    name = "x_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    for t in adapter.TABLE_NAMES:
        getattr(qa, t).write.saveAsTable(f"{name}.{t}")
    return name, qa, post_tags(qa.posts, qa.tags)


@pytest.mark.parametrize("number", sorted(ANALYTICS))
def test_explorer_equals_registry(spark, site, number):
    name, qa, pt = site
    got = run_query(spark, name, number, **PARAMS.get(number, {}))
    want = registry.bodies()[KEYS[number]][0](qa, pt)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
