"""Trip-record analytics on Spark: operators, sources, batch plans and streams."""

from farelight.session import build_session, work_path

__all__ = ["build_session", "work_path"]
