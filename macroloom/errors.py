"""Exceptions a caller can catch."""


class NoDataError(Exception):
    """The requested release cannot be served."""


class VersionNotAvailableError(NoDataError):
    """The release is absent from the dataflow mapping (a bulk archive may still hold it)."""


class DataflowDiscoveryError(NoDataError):
    """The landed catalogue lists no bare ``WEO`` dataflow, so no release can be resolved."""


class UnexpectedFileError(Exception):
    """A release archive does not hold exactly one XML and one XSD member."""


class BulkPayloadCorruptError(Exception):
    """A release archive is not a zip, or one of its members fails its CRC."""

    def __init__(self, message, *, key=None, reason=None, is_retryable=True):
        super().__init__(message)
        self.key = key
        self.reason = reason
        self.is_retryable = is_retryable
