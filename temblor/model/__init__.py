"""Magnitude model (Spark ML pipeline)."""

from .forest import (FEATURES, LABEL, build_pipeline, evaluate, importances, load,
                    prepare, save, split, train)

__all__ = [n for n in dir() if not n.startswith("_")]
