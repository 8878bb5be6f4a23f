"""Daily store-sales forecasting on Spark: features, exploration, models and ensembles."""

from importlib import import_module

# The public names and their modules; loaded on first use, so that Python workers stay light.
_PUBLIC = {
    "tune": "tillcast.session",
    "read_csv": "tillcast.sources.schema",
    "read_featured": "tillcast.sources.schema",
    "read_scores": "tillcast.sources.sinks",
    "build_features": "tillcast.plans.build",
    "add_features": "tillcast.plans.build",
    "build_exploration": "tillcast.plans.explore",
    "TrainOptions": "tillcast.plans.jobs",
    "train_and_submit": "tillcast.plans.jobs",
    "cross_from_saved": "tillcast.plans.jobs",
    "save_family": "tillcast.plans.train",
    "load_family": "tillcast.plans.train",
    "forecast": "tillcast.plans.train",
    "cross_forecast": "tillcast.plans.train",
}
__all__ = list(_PUBLIC)


def __getattr__(name: str):
    if name not in _PUBLIC:
        raise AttributeError(name)
    return getattr(import_module(_PUBLIC[name]), name)
