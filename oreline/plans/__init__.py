"""Registered queries, grouped by subject, each with its SQL check where SQL can express it."""

from importlib import import_module

_SUBJECTS = (
    "tables", "profiles", "text", "baskets", "pages", "supervised", "unsupervised",
    "series", "networks",
)


def load_all():
    """Import every subject module so that its queries are registered."""
    from . import registry
    for name in _SUBJECTS:
        import_module(f"{__name__}.{name}")
    return registry
