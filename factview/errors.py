"""Everything that the engine refuses, by name."""

from __future__ import annotations


class RelationError(ValueError):
    """A key graph or a path through it is not sound."""


class AmbiguousPathError(RelationError):
    """Several safe routes lead to the target."""


class FanOutError(RelationError):
    """A route or join multiplies rows without being asked to."""


class ManifestError(ValueError):
    """A dataset's description is not sound."""


class OrphanFactsError(ValueError):
    """Facts have keys that the joined component lacks."""


class ComponentKeyError(ValueError):
    """A component's declared key has nulls or repeats."""


class ComponentColumnsError(ValueError):
    """A component's source lacks a declared column."""


class UnsupportedTypeError(TypeError):
    """A dataset's column has a type that components cannot hold."""


class PublishConflict(RuntimeError):
    """What is live is not what staging saw, or dependents were not staged again."""


class KeptOldExists(RuntimeError):
    """An older generation is still kept under the same name."""


class DatasetNotPublished(LookupError):
    """The dataset has no published relation."""


class ReconciliationError(RuntimeError):
    """Pruning was asked for without being authoritative."""
