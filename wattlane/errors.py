"""Exception types shared by the operators."""


class DataValidationError(ValueError):
    """Raised when panel input fails a validation rule."""
