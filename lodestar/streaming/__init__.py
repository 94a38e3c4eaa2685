from lodestar.streaming import messages, operators  # noqa: F401
