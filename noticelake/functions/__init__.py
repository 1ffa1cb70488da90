"""Column building blocks. Nothing here triggers a job or reads the clock."""

from . import classify, dates, facts, redact, text, urls  # noqa: F401
