"""Every operator as a query over the driver's tables, with its SQL twin."""

from registry import analysis, cleaning, filters, findings, quality, series, stores
from registry.common import Registry


def all_queries() -> Registry:
    out = Registry()
    for part in (cleaning, quality, filters, analysis, series, findings, stores):
        out.merge(part.REGISTRY)
    return out
