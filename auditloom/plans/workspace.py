"""The stages of one data folder, each built once per session and kept as a staged table."""

from threading import RLock


from auditloom.operators.clean import clean
from auditloom.plans.pipeline import flag_raw
from auditloom.plans.warehouse import build_tables
from auditloom.sources.events import load_transactions
from auditloom.sources.transactions import staging
from auditloom.storage import spread_small, staged

_OPEN = {}
_LOCK = RLock()


class Workspace:
    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder
        self._stages = {}

    def _stage(self, name, build):
        with _LOCK:
            if name not in self._stages:
                self._stages[name] = build()
            return self._stages[name]

    def transactions(self):
        """Raw transactions derived from the events."""
        return self._stage("raw", lambda: staged(
            spread_small(load_transactions(self.spark, self.folder)), "raw"))

    def staging(self):
        return staging(self.transactions())

    def clean(self):
        return self._stage("clean", lambda: staged(clean(self.transactions()), "clean"))

    def flagged(self):
        """All rule signals and the score, without the forest, so plain SQL can check them."""
        return self._stage("flagged", lambda: staged(
            flag_raw(self.transactions(), multivariate=False), "flagged"))

    def flagged_with_forest(self):
        return self._stage("forest", lambda: flag_raw(self.transactions()))

    def tables(self):
        """The star schema over ``flagged``."""
        return self._stage("tables", lambda: build_tables(self.flagged()))

    def fact(self):
        return self.tables()["fact_transactions"]

    def all_tables(self):
        """The star schema over all seven signals."""
        return self._stage("all_tables", lambda: build_tables(self.flagged_with_forest()))


def workspace(spark, folder):
    key = (spark.sparkContext.applicationId, str(folder))
    with _LOCK:
        if key not in _OPEN:
            _OPEN[key] = Workspace(spark, str(folder))
        return _OPEN[key]


def reset():
    """Forget all stages, so that the next query builds its own."""
    _OPEN.clear()
