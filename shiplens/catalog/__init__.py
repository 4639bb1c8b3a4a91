"""Registered queries over the given tables, with the SQL that checks them."""

from shiplens.catalog import (  # noqa: F401
    activity,
    containment,
    forecasts,
    graphs,
    landing,
    monitoring,
    nullkeys,
    paths,
    reports,
    results,
    storage,
    streams,
    terms,
    texts,
    triage,
)
from shiplens.catalog.registry import ORACLES, QUERIES  # noqa: F401
