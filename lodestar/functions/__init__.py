from lodestar.functions import vocab, columns  # noqa: F401
