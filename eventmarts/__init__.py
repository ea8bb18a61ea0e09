"""eventmarts: Spark-native event analytics -- ingest, conform, sessionize,
facts, funnel, active users, cohort retention, reports and quality checks."""

from eventmarts.session import build_session, configure, shared_dir

__all__ = ["build_session", "configure", "shared_dir"]
