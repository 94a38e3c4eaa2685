from lodestar.sources import tables, fixtures  # noqa: F401
