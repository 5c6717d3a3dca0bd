"""Saved transforms and models."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_saved(path: str, load: Callable):
    """The model at ``path``, or None if there is nothing saved there."""
    try:
        return load(path)
    except (Py4JJavaError, AnalysisException) as e:
        if any(word in str(e) for word in ("does not exist", "PATH_NOT_FOUND")):
            return None
        raise


def load_first(paths: list[str], load: Callable = PipelineModel.load):
    """The first of the paths that loads; the error names every path tried."""
    failures = []
    for path in paths:
        try:
            return load(path)
        except Exception as e:  # noqa: BLE001 - any failure moves on to the next place
            failures.append(f"{path}: {type(e).__name__}: {str(e).splitlines()[0][:200] if str(e) else ''}")
    raise RuntimeError("no saved model could be loaded; tried " + "; ".join(failures))
