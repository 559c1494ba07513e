"""Where the stored tables live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import (
    APPLIED,
    CHANGES,
    DIVIDEND,
    LANDED_PRICE,
    MARKS,
    MEMBERSHIP,
    METRICS,
    PRICE,
    PRICE_STATE,
    PRICE_VIEW,
    PROFILE,
    QUARANTINE,
    SPELLS,
)
from .tables import scan_table


@dataclass(frozen=True)
class Lake:
    """Paths under one root, on any file system Spark can reach from every executor."""

    root: str

    @property
    def price(self) -> str:
        return f"{self.root}/bronze/bronze_price_daily"

    @property
    def dividends(self) -> str:
        return f"{self.root}/bronze/bronze_dividend_events"

    @property
    def metrics(self) -> str:
        return f"{self.root}/silver/silver_dividend_metrics_daily"

    @property
    def changes(self) -> str:
        return f"{self.root}/membership/membership_changes"

    @property
    def membership(self) -> str:
        return f"{self.root}/membership/membership_daily"

    @property
    def profiles(self) -> str:
        return f"{self.root}/bronze/company_profile"

    @property
    def applied(self) -> str:
        return f"{self.root}/silver/applied_event_days"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/silver/quarantine"

    @property
    def marks(self) -> str:
        return f"{self.root}/bronze/dividend_marks"

    @property
    def spells(self) -> str:
        return f"{self.root}/membership/membership_spells"

    @property
    def landed_price(self) -> str:
        return f"{self.root}/bronze/landed_price"

    @property
    def price_view(self) -> str:
        return f"{self.root}/gold/price_timeseries"

    @property
    def price_state(self) -> str:
        return f"{self.root}/gold/price_state"

    def stream_checkpoint(self, stream: str) -> str:
        return f"{self.root}/streams/{stream}"

    def read_landed_price(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.landed_price, LANDED_PRICE, missing)

    def read_price_view(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.price_view, PRICE_VIEW, missing)

    def read_price_state(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.price_state, PRICE_STATE, missing)

    def read_applied(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.applied, APPLIED, missing)

    def read_quarantine(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.quarantine, QUARANTINE, missing)

    def read_marks(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.marks, MARKS, missing)

    def read_spells(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.spells, SPELLS, missing)

    def read_price(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.price, PRICE, missing)

    def read_dividends(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.dividends, DIVIDEND, missing)

    def read_metrics(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.metrics, METRICS, missing)

    def read_changes(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.changes, CHANGES, missing)

    def read_membership(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.membership, MEMBERSHIP, missing)

    def read_profiles(self, spark: SparkSession, missing: str = "empty") -> DataFrame:
        return scan_table(spark, self.profiles, PROFILE, missing)
