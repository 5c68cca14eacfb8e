"""Settings for jobs that hand whole texts to Python."""

from starloom.session import bound_batches  # noqa: F401
