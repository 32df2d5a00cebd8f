"""Named queries over the benchmark tables."""

from importlib import import_module

MODULES = ("risk_queries", "log_queries", "intel_queries", "detect_queries", "stream_queries", "file_queries")


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
