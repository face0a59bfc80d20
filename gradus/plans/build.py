"""From feature tables to trained models in one call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame

from gradus.functions.scalars import dated_name
from gradus.operators.assemble import select_sources
from gradus.operators.trees import gbt_grid_search
from gradus.plans.runs import logistic_run
from gradus.plans.specs import InputSpec, build_input
from gradus.sources import replace_table, stale_tables, term_changed_tables
from gradus.session import materialise

ASSEMBLE_ONLY, LOGISTIC, BOOSTED = "", "LR", "XGBoost"


@dataclass
class BuildResult:
    """Tables due for a refresh, the written input table and one run per model."""

    due: DataFrame
    table_name: str
    rows: DataFrame
    runs: dict[str, object] = field(default_factory=dict)
    notices: list[str] = field(default_factory=list)


def due_tables(
    spec: InputSpec, build_log: DataFrame, calendar: DataFrame, as_of: date, waited_days: int
) -> DataFrame:
    """Daily tables too old and census tables built in another term."""
    spark = build_log.sparkSession

    def named(names: Sequence[str]) -> DataFrame:
        return spark.createDataFrame([(n,) for n in names], "table_name string")

    old = stale_tables(build_log, as_of, waited_days, named(spec.daily)).select("table_name")
    turned = term_changed_tables(build_log, as_of, calendar, named(spec.census)).select("table_name")
    return old.union(turned).distinct()


def build_model(
    spec: InputSpec,
    tables: Mapping[str, DataFrame],
    build_log: DataFrame,
    calendar: DataFrame,
    as_of: date,
    key: str,
    label: str,
    exclude: Sequence[str] = (),
    models: Sequence[str] = (ASSEMBLE_ONLY,),
    sources: Sequence[str] | None = None,
    waited_days: int = 120,
    output: str | None = None,
    logistic: Mapping | None = None,
    boosted: Mapping | None = None,
) -> BuildResult:
    """List the tables due, assemble and write the input, then run each model named.

    An empty model name assembles only; an unknown one leaves a notice. Dozens
    of joins end in one written table, so the models start from a short plan.
    """
    spark = build_log.sparkSession
    due = due_tables(spec, build_log, calendar, as_of, waited_days)
    built = build_input(spec, tables, sources)
    asked = "".join(f"_{s}" for s in sources) if sources and select_sources(spec.sources, sources) else ""
    name = dated_name(spec.name + asked, as_of, spec.lower_month)
    if output:
        target = f"{output}/{name}" if "/" in output else f"{output}.{name}"
        replace_table(built, target)
        rows = spark.read.parquet(target) if "/" in output else spark.table(target)
    else:
        rows = materialise(built)
    result = BuildResult(due, name, rows)
    for model in models:
        if model == LOGISTIC:
            result.runs[model] = logistic_run(rows, key, label, exclude, **(logistic or {}))
        elif model == BOOSTED:
            result.runs[model] = gbt_grid_search(rows, key, label, exclude, name=name, **(boosted or {}))
        elif model != ASSEMBLE_ONLY:
            result.notices.append(f"Unrecognized model name: {model}")
    return result
