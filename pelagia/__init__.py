"""Pelagia: Spark jobs that turn marine sampling tables into data products."""

from .session import local_session, tune

__all__ = ["local_session", "tune"]
