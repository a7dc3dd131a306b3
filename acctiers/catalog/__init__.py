"""Named queries over the test tables, with the SQL that checks them."""

from acctiers.catalog.registry import REGISTRY


def load() -> dict:
    """All registered queries; importing the modules registers them."""
    from acctiers.catalog import loads, monitoring, quality, tiering, validation, warehouse  # noqa: F401

    return REGISTRY
