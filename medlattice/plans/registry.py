"""Named queries: each is a Spark DataFrame builder plus (where SQL can
express it) the equivalent DuckDB oracle SQL over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from medlattice.sources import fixtures as fx


@dataclass
class QuerySpec:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    survey_ids: tuple[str, ...]


REGISTRY: dict[str, QuerySpec] = {}


def query(name: str, oracle: str | None = None, ids: tuple[str, ...] = ()):
    """Register ``fn(fixture) -> DataFrame`` under ``name``."""

    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixture(spark, sf_dir))

        build.__name__ = name
        build.__doc__ = fn.__doc__
        REGISTRY[name] = QuerySpec(name, build, oracle, ids)
        return fn

    return deco


class Fixture:
    """Lazy fixture views for one data folder (plain DataFrames, not cached)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    @cached_property
    def line(self) -> DataFrame:
        return fx.line(self.spark, self.dir)

    @cached_property
    def events(self) -> DataFrame:
        return fx.events(self.line)

    @cached_property
    def mortality(self) -> DataFrame:
        return fx.mortality(self.spark, self.dir, self.events)

    @cached_property
    def records(self) -> DataFrame:
        return fx.clinical_records(self.line)

    @cached_property
    def diagnostics(self) -> DataFrame:
        return fx.diagnostics(self.line)

    @cached_property
    def medications(self) -> DataFrame:
        return fx.medications(self.line)

    @cached_property
    def labs(self) -> DataFrame:
        return fx.lab_results(self.line)

    @cached_property
    def graph_records(self) -> DataFrame:
        return fx.graph_records(self.line)

    @cached_property
    def graph_patients(self) -> DataFrame:
        return fx.graph_patients(self.spark, self.dir)

    @cached_property
    def admissions(self) -> DataFrame:
        return fx.admissions(self.spark, self.dir).withColumn("split", fx.subject_split())

    @cached_property
    def diagnoses_icd(self) -> DataFrame:
        return fx.diagnoses_icd(self.line)

    @cached_property
    def subject_mortality(self) -> DataFrame:
        return fx.subject_mortality(self.spark, self.dir)
