"""Exceptions a run can end with."""


class HeaderNotFound(RuntimeError):
    """A workbook has the sheet but no block of rows holding the key columns."""


class SchemaMismatch(ValueError):
    """A stored table lacks columns its contract requires."""


class IntegrityError(Exception):
    """Derived tables do not add up to the cases they were computed from."""


class ConfigError(ValueError):
    """The session or a run lacks a setting the job cannot do without."""
