"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). The cells' weights are raked: scaled to each
dimension's target shares in turn until all of them hold. A cell's weight over its tokens calibrates
the probability with which each of its documents is sampled. The documents are read for the sums and
for the sampling; all rounds in between work on the cells alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.tables import unit_interval
from wattframe.session import keep

ROUNDS, TOLERANCE = 30, 1e-4
#: Cells that are raked in one task, without shuffles.
FEW_CELLS = 100_000
NONE = "(none)"


def words(text: Column) -> Column:
    """Words of a text, by white space; the tokens that a weight counts."""
    trimmed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, " "))).cast("long")


def kind_of(text: Column) -> Column:
    """A text's topic as its form shows it: table, shouting, marked-up, secret-like or prose."""
    return (
        F.when(text.contains(" | "), "table")
        .when((text == F.upper(text)) & (text != F.lower(text)), "shouting")
        .when(text.rlike(r"[#$%&*]{3}"), "marked")
        .when(text.rlike(r'\w = "'), "secrets")
        .otherwise("prose")
    )


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares: each value's share of tokens, raised to ``power`` (0: equal, 1: as it is)."""
    totals = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    raised = totals.select(F.col(dimension).alias("value"), F.pow("tokens", F.lit(power)).alias("share"))
    return raised


def _together(cells: DataFrame, few: bool) -> DataFrame:
    """A few cells in one partition: sums and joins over them then need no shuffle."""
    return cells.coalesce(1) if few else cells


def raked(
    cells: DataFrame,
    targets: dict[str, DataFrame],
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``cells`` with ``weight``, whose sums per dimension have the target shares.

    ``targets`` has a table ``value, share`` per dimension; shares are of any scale, values without
    cells do not count, and cells whose value has no target get weight 0. Weights sum up to the
    tokens. The rounds end when no share is off by more than ``tolerance``; targets that contradict
    each other (through cells that are missing) end after ``rounds``, with the last dimension exact.

    A round is one written table and one look at how far its factors were from 1, which is how far
    off the shares were. Up to ``FEW_CELLS`` cells are counted and worked on in one task; more are shuffled.
    """
    total, count = cells.agg(F.sum("tokens"), F.count("*")).first()
    total, few = total or 0, count <= FEW_CELLS
    fitted = keep(_together(cells, few).withColumn("weight", F.col("tokens").cast("double")))
    goals = {}
    for name, target in targets.items():
        has = _together(fitted, few).groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("has"))
        present = target.join(has.where("has > 0"), "value").where("share > 0")
        present = keep(_together(present.select("value", F.col("share").cast("double").alias("share")), few))
        whole = present.agg(F.sum("share")).first()[0] or 1.0
        goals[name] = present.select(
            F.col("value").alias(name), (F.col("share") / whole * total).alias("goal")
        )
    for _ in range(rounds):
        fitted = _together(fitted.select(*cells.columns, "weight"), few).withColumn("_off", F.lit(0.0))
        for name, goal in goals.items():
            has = fitted.groupBy(name).agg(F.sum("weight").alias("has"))
            factor = has.join(_together(goal, few), name, "left").select(
                name,
                F.when(F.col("has") > 0, F.coalesce("goal", F.lit(0.0)) / F.col("has")).otherwise(0.0).alias("factor"),
                F.coalesce(F.abs(F.col("has") / F.col("goal") - 1), F.lit(0.0)).alias("off"),
            )
            fitted = fitted.join(factor, name).select(
                *cells.columns,
                (F.col("weight") * F.col("factor")).alias("weight"),
                F.greatest("_off", "off").alias("_off"),
            )
        fitted = keep(fitted)
        # A share met in its turn is moved again by the dimensions after it, by as much as they were off.
        if (fitted.agg(F.max("_off")).first()[0] or 0.0) * len(goals) <= tolerance:
            break
    return fitted.select(*cells.columns, "weight")


def probabilities(fitted: DataFrame, fraction: float) -> DataFrame:
    """Cells with ``probability``: proportional to weight over tokens, so that the sample has the targets.

    The factor is set so that ``fraction`` of all tokens is expected to stay, or as much as the
    targets let: no cell's probability would be more than 1, as a cut cell leaves its share to others.
    """
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    used = fitted.where((F.col("tokens") > 0) & (F.col("weight") > 0))
    row = used.agg(F.sum("weight"), F.max(ratio), F.sum("tokens")).first()
    if not row[2]:
        return fitted.withColumn("probability", F.lit(1.0))
    factor = min(fraction * row[2] / row[0], 1.0 / row[1])
    return fitted.withColumn("probability", F.least(ratio * factor, F.lit(1.0)))


def mixed(
    docs: DataFrame,
    dimensions: dict[str, Column],
    tokens: Column,
    targets: dict[str, DataFrame | float],
    fraction: float = 0.5,
    seed: str = "mix",
    id_col: str = "doc_id",
) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns, and ``sampling_weight`` (1 / probability).

    ``dimensions`` names what is balanced; each has a table of target shares or a power for
    :func:`tempered`. A NULL value is a value of its own, ``(none)``. Whether a document stays depends
    on its identifier and ``seed`` only, so rows that repeat one share its lot if they share a cell,
    and all rows without identifier in a cell share theirs. A row without tokens (NULL or empty text) weighs
    nothing and stays with its cell's probability (in a cell without any token: always). Other columns
    pass unchanged whatever their names (but ``sampling_weight`` is replaced); no rows in, no rows out.
    """
    hidden = {name: f"__{name}" for name in dimensions}
    marked = docs.withColumns(
        {hidden[name]: F.coalesce(value.cast("string"), F.lit(NONE)) for name, value in dimensions.items()}
    )
    cells = marked.groupBy(*hidden.values()).agg(F.sum(tokens).alias("tokens"))
    cells = keep(cells.select(*[F.col(h).alias(n) for n, h in hidden.items()], "tokens"))
    goals = {
        name: target if isinstance(target, DataFrame) else tempered(cells, name, target)
        for name, target in targets.items()
    }
    chances = probabilities(raked(cells, goals), fraction)
    chances = keep(
        chances.select(
            *[F.col(n).alias(h) for n, h in hidden.items()],
            F.when(F.col("tokens") > 0, F.col("probability")).otherwise(1.0).alias("__probability"),
        )
    )
    drawn = unit_interval(F.lit(seed), F.col(id_col).cast("string"))
    return (
        marked.join(chances, list(hidden.values()))
        .where(drawn < F.col("__probability"))
        .select(
            *[F.col(f"`{name}`") for name in docs.columns if name != "sampling_weight"],
            (1 / F.col("__probability")).alias("sampling_weight"),
        )
    )
