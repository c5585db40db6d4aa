class SpecError(ValueError):
    """A study definition is contradictory or incomplete."""


class DataContractError(RuntimeError):
    """Data do not satisfy what a study definition asks of them."""
