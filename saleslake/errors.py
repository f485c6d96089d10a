"""Errors raised by the engine. Messages carry names and counts, never credentials."""


class SaleslakeError(RuntimeError):
    """Base class."""


class ContractError(SaleslakeError):
    """A declaration (type, table, rule, domain) is wrong or unknown."""


class IngestError(SaleslakeError):
    """A source cannot be landed."""


class QualityError(SaleslakeError):
    """A quality operator was misused or broke one of its invariants."""
