"""Errors by what they mean to a caller."""


class EngineError(RuntimeError):
    """Base of all errors raised on purpose."""


class ConfigurationError(EngineError):
    """An input or a setting is malformed."""


class AuthorizationError(EngineError):
    """A source, teacher or reviewer may not be used."""


class GateError(EngineError):
    """A mandatory check failed."""


class ImmutableArtifactError(EngineError):
    """An artifact that is written once exists or has changed."""
