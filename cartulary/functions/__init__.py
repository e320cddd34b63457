from . import dates, numbers, text, urls  # noqa: F401
