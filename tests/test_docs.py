"""Documentation stays in step with the registry."""

import os
import re

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_registered_query_is_in_the_coverage_map_and_readme():
    cov = open(os.path.join(ROOT, "COVERAGE.md")).read()
    readme = open(os.path.join(ROOT, "README.md")).read()
    for name in E.CORE_QUERIES:
        assert re.search(r"\b" + name + r"\b", cov), name
        assert re.search(r"\b" + name + r"\b", readme), name
    assert f"{len(E.CORE_QUERIES)} registered queries" in readme
