"""Errors raised by data-quality checks and argument validation."""


class BasketError(Exception):
    """Base class of every error raised by basketspark."""


class DataValidityError(BasketError):
    """A required input is empty or malformed (e.g. no product groups)."""


class OutputOutOfBoundError(BasketError):
    """A computed quantity left its admissible range (e.g. confidence > 1)."""


class InputNotValidError(BasketError):
    """An argument is not one of the accepted values (e.g. unknown division)."""


class CoverageError(BasketError):
    """A source table does not cover the requested date window."""
