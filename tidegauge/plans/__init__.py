"""Named queries over the test tables, and SQL that defines their results."""

from __future__ import annotations

from importlib import import_module

from tidegauge.session import configure

_AREAS = ["weather", "taxi", "serving", "streams"]


def _configured(build):
    def run(spark, sf_dir):
        return build(configure(spark), sf_dir)
    return run


def all_queries():
    out = {}
    for area in _AREAS:
        for name, build in import_module(f"tidegauge.plans.{area}").QUERIES.items():
            out[name] = _configured(build)
    return out


def all_sql():
    out = {}
    for area in _AREAS:
        out |= import_module(f"tidegauge.plans.{area}").SQL
    return out
