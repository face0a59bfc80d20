"""Mixing sources to target weights by iterative proportional fitting, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.functions.scalars import hash_uniform
from gradus.llm.base import columns_of, materialise

DIMENSIONS = ("source", "lang", "topic")

# Stands for a null source or language.
NONE = "(none)"

# Target shares follow tokens to this power, so that large values give way to small ones.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}

SWEEPS = 8
SEED = "mix"

SEPARATORS = " \t\n\r"
DIGITS = "0123456789"
MARKS = "%#*$&!"


def _count(text: Column, characters: str) -> Column:
    """How many of the given characters a text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def token_count(text: Column) -> Column:
    """Separators and one; none for a null or empty text."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(_count(text, SEPARATORS) + 1).cast("long")


def topic_of(text: Column) -> Column:
    """Kind of content by share of characters: brief, list, marked, figures or prose."""
    length = F.length(text)
    return (
        F.when(F.coalesce(length, F.lit(0)) < 400, "brief")
        .when(_count(text, "|") * 50 >= length, "list")
        .when(_count(text, MARKS) * 20 >= length, "marked")
        .when(_count(text, DIGITS) * 100 >= length, "figures")
        .otherwise("prose")
    )


def _places() -> list[Column]:
    """The dimensions of a row and its weight in tokens."""
    return [
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
        topic_of(F.col("text")).alias("topic"),
        token_count(F.col("text")).alias("tokens"),
    ]


def tempered_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target share of each value of a dimension: its tokens to a power, normalised."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0")
    raised = sums.select(dimension, F.pow(F.col("t").cast("double"), F.lit(power)).alias("p"))
    total = raised.agg(F.sum("p").alias("p")).scalar()
    return raised.select(dimension, (F.col("p") / total).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """Scale the weights of the cells to the target shares of one dimension after the other.

    ``cells`` has the dimensions and ``tokens``; each frame of ``targets`` has its
    dimension and ``target``. Adds ``weight``, which sums to one. Values without a
    target and cells without tokens weigh nothing; targets of values that no cell
    has are left out, and the others are raised alike.
    """
    total = cells.agg(F.sum("tokens").alias("t")).scalar()
    fitted = materialise(
        cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double") / total.cast("double"))
    )
    present = {}
    for name, target in targets.items():
        own = target.join(fitted.select(name).distinct(), name)
        present[name] = materialise(own.select(name, (F.col("target") / own.agg(F.sum("target")).scalar()).alias("target")))
    for _ in range(sweeps):
        for name, target in present.items():
            sums = fitted.groupBy(name).agg(F.sum("weight").alias("now")).where("now > 0")
            factor = sums.join(target, name).select(name, (F.col("target") / F.col("now")).alias("factor"))
            fitted = materialise(
                fitted.join(factor, name).select(
                    *DIMENSIONS, "tokens", (F.col("weight") * F.col("factor")).alias("weight")
                )
            )
    whole = fitted.agg(F.sum("weight")).scalar()
    return fitted.withColumn("weight", F.col("weight") / whole)


def calibrate(
    places: DataFrame, targets: dict[str, DataFrame] | None = None, rate: float = 1.0, sweeps: int = SWEEPS
) -> DataFrame:
    """Weight, probability and sample weight of each cell of (source, lang, topic).

    A cell whose tokens are to weigh r times their share is sampled with probability
    min(1, rate * r). ``sample_weight`` = rate * r / probability makes up for what
    the probability can't exceed, so that weighted tokens meet the targets in expectation.
    """
    cells = materialise(places.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    if targets is None:
        targets = {name: tempered_targets(cells, name, power) for name, power in POWERS.items()}
    total = cells.agg(F.sum("tokens")).scalar()
    wanted = F.lit(rate) * F.col("weight") * total.cast("double") / F.col("tokens")
    fitted = rake(cells, targets, sweeps).select(*DIMENSIONS, "weight", F.round(wanted, 9).alias("wanted"))
    return materialise(
        fitted.select(
            *DIMENSIONS,
            F.round("weight", 9).alias("cell_weight"),
            F.least(F.col("wanted"), F.lit(1.0)).alias("probability"),
            F.greatest(F.col("wanted"), F.lit(1.0)).alias("sample_weight"),
        )
    )


def _drawn(rows: DataFrame, calibrated: DataFrame) -> DataFrame:
    """Adds the cell's figures and whether the row's draw, fixed by its id, falls below the probability."""
    found = rows.join(calibrated, list(DIMENSIONS), "left")
    chance = F.coalesce("probability", F.lit(0.0))
    return found.withColumns(
        {
            "cell_weight": F.coalesce("cell_weight", F.lit(0.0)),
            "probability": chance,
            "sample_weight": F.coalesce("sample_weight", F.lit(0.0)),
            "sampled": hash_uniform(SEED, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) < chance,
        }
    )


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, rate: float = 1.0) -> DataFrame:
    """Calibrated sample of the documents, one row per input row.

    Returns doc_id, source, lang, topic, tokens, cell_weight, probability,
    sample_weight and sampled. Without ``targets`` shares are tempered (``POWERS``).

    Nulls and edges: a null source or language counts as the value "(none)"; null and
    empty texts are brief and have no tokens, and a cell without tokens gets probability 0; a null id draws
    like an empty one, and rows that repeat an id draw alike. Further columns, also
    ones named like the result's, are not read. An empty table gives no rows.
    """
    rows = materialise(docs.select("doc_id", *_places()))
    return _drawn(rows, calibrate(rows, targets, rate)).select(
        "doc_id", *DIMENSIONS, "tokens", "cell_weight", "probability", "sample_weight", "sampled"
    )


def sample_mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, rate: float = 1.0) -> DataFrame:
    """The sampled documents with all columns and ``sample_weight``, which replaces a column of that name.

    Nulls and edges: as ``mix``. Columns may have any names.
    The cells of the rows are worked out once and written beside them.
    """
    docs = docs.drop("sample_weight")
    rows = materialise(docs.select(F.struct(*columns_of(docs)).alias("row"), "doc_id", *_places()))
    calibrated = calibrate(rows.select(*DIMENSIONS, "tokens"), targets, rate)
    return _drawn(rows, calibrated).where("sampled").select("row.*", "sample_weight")
