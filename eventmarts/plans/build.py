"""Model build steps over the driver binding (used by the query catalogue and
the benchmark).  Each step is a lazy DataFrame; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmarts.operators import historical, marts, sessions, staging
from eventmarts.sources import binding


def _memo(fn):
    """Build each layer once per Model: one DataFrame object per layer keeps
    plans small to analyze and lets Spark reuse identical exchanges."""
    def wrapper(self):
        key = fn.__name__
        if key not in self._built:
            self._built[key] = fn(self)
        return self._built[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


class Model:
    """Lazily built layers for one ``events`` table."""

    def __init__(self, spark: SparkSession, sf_dir: str, gap_minutes: int = 30):
        self.spark = spark
        self.sf_dir = sf_dir
        self.gap = gap_minutes
        self._built: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = binding.read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    # bronze shapes
    @_memo
    def stream_bronze(self) -> DataFrame:
        return binding.stream_bronze(self.table("events"))

    @_memo
    def raw_csv(self) -> DataFrame:
        return binding.raw_csv(self.table("events"))

    @_memo
    def historical_bronze(self) -> DataFrame:
        return historical.transform(self.raw_csv())

    # staging / intermediate
    @_memo
    def stg_stream(self) -> DataFrame:
        return staging.stage_stream(self.stream_bronze())

    @_memo
    def stg_historical(self) -> DataFrame:
        return staging.stage_historical(self.historical_bronze())

    @_memo
    def conformed(self) -> DataFrame:
        return staging.conform(self.stg_stream(), self.stg_historical())

    @_memo
    def sessions(self) -> DataFrame:
        return sessions.sessions(self.conformed(), self.gap)

    @_memo
    def sessionized(self) -> DataFrame:
        return sessions.sessionize(self.conformed(), self.gap)

    @_memo
    def fact_rows(self) -> DataFrame:
        """The rows of the event fact without session columns: what counts of events
        and users need, with no session scan behind it."""
        return sessions.attachable(self.conformed()).select(
            "source", "user_id", "event_type", "event_timestamp", "event_date")

    # marts
    @_memo
    def fct_events(self) -> DataFrame:
        return marts.event_fact(self.sessionized())

    @_memo
    def fct_sessions(self) -> DataFrame:
        return marts.session_fact(self.sessions())

    @_memo
    def dim_date(self) -> DataFrame:
        return marts.date_spine(self.conformed())
