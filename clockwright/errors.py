"""Errors raised by the library."""


class ExtractionError(RuntimeError):
    """A required raw input is missing or cannot be read."""


class TransformationError(RuntimeError):
    """A table breaks a rule that must hold before the next step."""


class LoadError(RuntimeError):
    """A table cannot be written."""


class LookupFailed(RuntimeError):
    """A requested record does not exist or may not be shown."""
