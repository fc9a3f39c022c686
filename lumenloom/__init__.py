"""Product-catalogue and event analytics written as plain PySpark functions."""

from lumenloom.session import get_session, prepare, shared_dir

__all__ = ["get_session", "prepare", "shared_dir"]
