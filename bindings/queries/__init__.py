"""All registered queries; importing this package fills the registry."""

from bindings.queries import (  # noqa: F401
    challenges, experiments, growth, primitives, signup, tours,
)
