from . import sales  # noqa: F401
