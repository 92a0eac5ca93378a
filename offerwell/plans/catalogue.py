"""All registered queries in one place."""

from __future__ import annotations

from offerwell.plans import registry
from offerwell.plans import features, listings, marketplace, models, negotiation, pages, parsing, streams, warehouse  # noqa: F401


def callables():
    return registry.callables()


def checks():
    return dict(registry.CHECKS)
