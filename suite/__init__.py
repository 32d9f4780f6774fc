"""The operators run on the driver's tables, each beside the SQL it must equal."""

from suite.registry import CASES, case  # noqa: F401


def load_all() -> None:
    import importlib

    for name in ("sources", "records", "functions", "text", "pages", "recommend"):
        importlib.import_module(f"suite.{name}")
