"""Registry of models: what each reads, how it is built, and how its result is kept."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from ..operators.cleaning import clean_auth, clean_listen, clean_page_view
from ..operators.incremental import new_rows
from ..operators.upsert import merge
from ..session import settle
from ..sources.catalog import Sources
from . import marts

KINDS = ("table", "view", "incremental")


@dataclass(frozen=True)
class Model:
    name: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    materialized: str = "table"
    mark: str = "ts"
    merge_on: tuple[str, ...] = ()
    checks: tuple = field(default=())
    unique: tuple[str, ...] = ()

    def __post_init__(self):
        if self.materialized not in KINDS:
            raise ValueError(f"{self.name}: materialized must be one of {KINDS}")


_AUTH_CHECKS = (
    quality.not_null("ts"), quality.not_null("sessionId"), quality.not_null("itemInSession"),
    quality.accepted_values("level", ["free", "paid"]), quality.accepted_values("gender", ["F", "M"]),
    quality.accepted_values("success_boolean", [True, False]),
)
_FEEDS = ("src_listen_events", "src_auth_events", "src_page_view_events")


def _default() -> list[Model]:
    view = {"materialized": "view"}
    return [
        Model("src_auth_events", ("auth_events",), clean_auth, "incremental", checks=_AUTH_CHECKS,
              unique=("sessionId", "userId")),
        Model("src_listen_events", ("listen_events",), clean_listen, "incremental"),
        Model("src_page_view_events", ("page_view_events",), clean_page_view, "incremental"),
        Model("stg_streams_hourly", ("src_listen_events",), marts.stg_streams_hourly, **view),
        Model("stg_top_songs_artists", ("src_listen_events",), marts.stg_top_songs_artists, **view),
        Model("stg_unique_users", ("src_listen_events",), marts.stg_unique_users, **view),
        Model("stg_user_activity_per_country", _FEEDS, marts.stg_user_activity_per_country, **view),
        Model("stg_user_activity_per_location", _FEEDS, marts.stg_user_activity_per_location, **view),
        Model("stg_user_level_by_gender", ("src_auth_events",), marts.stg_user_level_by_gender, **view),
        Model("mart_hourly_stream_evolution", ("stg_streams_hourly",), marts.mart_hourly_stream_evolution),
        Model("mart_top_songs_artists", ("stg_top_songs_artists",), marts.mart_top_songs_artists),
        Model("mart_total_unique_users", ("stg_unique_users",), marts.mart_total_unique_users),
        Model("mart_user_activity_per_country", ("stg_user_activity_per_country",),
              marts.mart_user_activity_per_country),
        Model("mart_user_activity_per_state", ("stg_user_activity_per_location",),
              marts.mart_user_activity_per_state),
        Model("mart_user_level_by_gender", ("stg_user_level_by_gender",), marts.mart_user_level_by_gender),
    ]


MODELS = {m.name: m for m in _default()}


def _load_incremental(spark: SparkSession, model: Model, df: DataFrame, folder: str) -> DataFrame:
    """New rows are appended; with merge keys the merged rows are written aside first, then put in place."""
    try:
        current = spark.read.schema(df.schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)
    fresh = new_rows(df, current, model.mark)
    if model.merge_on:
        settle(merge(current, fresh, list(model.merge_on)), "merged").write.mode("overwrite").parquet(folder)
    else:
        fresh.write.mode("append").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def run_models(spark: SparkSession, sources: Sources, folder: str, models: dict[str, Model] | None = None,
               only: set[str] | None = None) -> dict[str, DataFrame]:
    """Build models after what they read. Cleaned feeds and marts are written once and read back; stage
    views stay plans. `only` limits the run to some models and what they need."""
    models = MODELS if models is None else models
    wanted, queue = set(), list(only or models)
    while queue:
        name = queue.pop()
        if name in models and name not in wanted:
            wanted.add(name)
            queue.extend(models[name].reads)
    built: dict[str, DataFrame] = {}
    for name in TopologicalSorter({n: models[n].reads for n in wanted}).static_order():
        if name not in models:
            built[name] = sources.read(spark, name)
            continue
        model = models[name]
        df = model.build(*[built[r] for r in model.reads])
        if model.materialized == "incremental":
            df = _load_incremental(spark, model, df, f"{folder}/{name}")
        elif model.materialized == "table":
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            df = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        else:
            df.createOrReplaceTempView(name)
        built[name] = df
    return built


def check_models(built: dict[str, DataFrame], models: dict[str, Model] | None = None,
                 fail_on_error: bool = False) -> DataFrame | None:
    """One row per check of the built models; raises instead when asked to and any check fails."""
    result = None
    for model in (MODELS if models is None else models).values():
        if model.name in built and (model.checks or model.unique):
            checks = quality.check_table(built[model.name], list(model.checks), model.unique)
            result = checks if result is None else result.unionByName(checks)
    return quality.gate(result) if fail_on_error and result is not None else result
