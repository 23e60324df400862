"""Queries over the supplied tables, grouped by subject."""

from importlib import import_module

SUBJECTS = ("cells", "pixels", "reports", "graphs", "summaries", "extensions")


def load_catalog():
    for subject in SUBJECTS:
        import_module(f"tissuegrid.plans.{subject}")
    return import_module("tissuegrid.plans.catalog")
