"""The whole lake derived from one input folder, each stage built once per application."""

from __future__ import annotations

import hashlib
import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from adlake.operators.conform import FEEDS
from adlake.plans.graph import Ontology, performance_ontology
from adlake.plans.medallion import GOLD, Medallion, SilverPlan
from adlake.plans.performance import performance_model
from adlake.plans.semantic import Model
from adlake.session import shared_folder
from adlake.sources.signals import FEED_MONEY, TIE_ORDER, ad_signals, feeds, fingerprint
from adlake.sources.tables import TableStore

STAGING = "staging/ad_signals"
PLAN = SilverPlan(FEEDS, FEED_MONEY, tie_order=TIE_ORDER)
_LAKES: dict[tuple[str, str], Lake] = {}


class Lake:
    """Bronze, silver and gold of one input folder, written to the shared folder on first use.

    A query pays for the stages it is first to need; later ones read the stored tables.
    """

    def __init__(self, spark: SparkSession, folder: str, identity: str):
        self.spark = spark
        self.folder = folder
        self.identity = identity
        place = hashlib.md5(f"{folder} {identity}".encode()).hexdigest()
        self.job = Medallion(TableStore(spark, f"{shared_folder(spark)}/lake-{place}"), PLAN)

    @cached_property
    def feeds(self) -> dict[str, DataFrame]:
        """The platform feeds. Signals are joined and stored once, a folder per platform, so a
        feed reads its own platform's files only."""
        store = self.job.store
        store.write(ad_signals(self.spark, self.folder), STAGING, partition_by=["source_system"])
        return feeds(store.read(STAGING))

    @cached_property
    def silver(self) -> DataFrame:
        return self.job.write_silver(self.feeds)

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        _ = self.silver
        return self.job.build_gold()

    @cached_property
    def model(self) -> Model:
        return performance_model(self.gold)

    @cached_property
    def ontology(self) -> Ontology:
        return performance_ontology(self.gold)

    def table(self, name: str) -> DataFrame:
        return self.gold[name]


def lake(spark: SparkSession, folder: str, look_again: bool = False) -> Lake:
    """The lake of an input folder. Its files are looked at once, and with ``look_again``; changed files give a new lake."""
    folder = os.path.normpath(folder) if "://" not in folder else folder.rstrip("/")
    key = (spark.sparkContext.applicationId, folder)
    if key not in _LAKES or look_again:
        identity = fingerprint(spark, folder)
        if key not in _LAKES or _LAKES[key].identity != identity:
            _LAKES[key] = Lake(spark, folder, identity)
    return _LAKES[key]


__all__ = ["GOLD", "Lake", "lake"]
