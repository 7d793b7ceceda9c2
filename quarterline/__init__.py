"""Period-comparison analytics on PySpark. Names load on first use, so importing the package needs no Spark."""

from importlib import import_module

__version__ = "0.1.0"

_HOME = {
    "BronzeLoadResult": "plans.layers",
    "SilverLoadResult": "plans.layers",
    "GoldLoadResult": "plans.layers",
    "load_bronze_observations": "plans.layers",
    "load_silver_observations": "plans.layers",
    "load_gold_observations": "plans.layers",
    "classify_rejection_reason": "operators.quality",
    "GoldConfig": "plans.serving",
    "CachedMart": "plans.serving",
    "fetch_companies": "plans.serving",
    "fetch_company_metrics": "plans.serving",
    "fetch_comparison": "plans.serving",
    "formatted_rows": "plans.serving",
}
__all__ = ["__version__", *_HOME]


def __getattr__(name: str):
    if name not in _HOME:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f"{__name__}.{_HOME[name]}"), name)
