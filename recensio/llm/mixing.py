"""Mix sources to target weights by iterative proportional fitting, with column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.llm.names import free_names
from recensio.session import materialize

#: Cells up to this number are broadcast to the documents (below 100 bytes each).
BROADCAST_CELLS = 200_000
MARGINS = ("source", "lang", "topic")
#: Rounds of raking at most.
ROUNDS = 20


def coarse_topic(text: Column) -> Column:
    """A topic for tables that have none: form and length of the text."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return (
        F.when(t.contains(" | "), "table")
        .when(t.contains("icens"), "licence")
        .when(F.char_length(t) < 1000, "short")
        .when(F.char_length(t) < 4000, "medium")
        .otherwise("long")
    )


def token_count(text: Column) -> Column:
    """Words of a text; runs of characters other than white space."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.regexp_count(t, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def tempered(cells: DataFrame, margin: str, temperature: float) -> DataFrame:
    """``(margin, share)``: target shares, the token shares raised to ``temperature``."""
    own = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t")).filter(F.col("t") > 0)
    total = own.agg(F.sum("t").alias("n"))
    raised = own.join(F.broadcast(total)).select(margin, F.pow(F.col("t") / F.col("n"), F.lit(temperature)).alias("p"))
    norm = raised.agg(F.sum("p").alias("z"))
    return raised.join(F.broadcast(norm)).select(margin, (F.col("p") / F.col("z")).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = 1e-10) -> DataFrame:
    """``cells(source, lang, topic, tokens)`` with ``weight``: shares whose margins equal the targets.

    ``targets[margin]`` is ``(margin, share)``. Each round scales the cells to
    one margin after another, until no factor differs from one by more than
    ``tolerance`` or after ``rounds`` rounds; ``fit`` is the last round's largest difference, so a caller
    sees targets that no weights can meet. Cells without tokens, or without a
    target, weigh nothing.
    """
    at = cells.filter(F.col("tokens") > 0).withColumn("weight", F.col("tokens").cast("double"))
    for margin in MARGINS:
        # each step is written: a plan that holds the steps before it twice doubles with every margin on the driver
        at = materialize(at.join(targets[margin].withColumnRenamed("share", f"_{margin}"), margin))
    for _ in range(rounds):
        for margin in MARGINS:
            # summed before rows meet, so a margin's value with very many cells is no task's burden
            sums = at.groupBy(margin).agg(F.sum("weight").alias("_sum"))
            at = at.join(sums, margin).withColumn(f"_by_{margin}", F.col(f"_{margin}") / F.col("_sum")).drop("_sum")
            at = materialize(at.withColumn("weight", F.col("weight") * F.col(f"_by_{margin}")))
        off = [F.max(F.abs(F.col(f"_by_{m}") - 1)) for m in MARGINS]
        worst = at.agg(F.greatest(*off)).first()[0]
        at = at.drop(*[f"_by_{m}" for m in MARGINS])
        if worst is None or worst <= tolerance:
            break
    return at.select(*MARGINS, "tokens", "weight", F.lit(worst).cast("double").alias("fit"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    topic: Column | None = None,
    temperature: float = 0.7,
    targets: dict[str, DataFrame] | None = None,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``mix_topic``, ``n_tokens``, ``ratio``, ``probability``, ``sampled`` and ``fit``.

    ``fit`` is how far the margins still were from the targets in the last round of raking, as a share; targets
    that contradict each other (a language in one source only, say) leave a ``fit`` well above zero, and
    then the last margin, topic, is met and the others are not.

    ``ratio`` is the raked share of a document's cell over its own share. Every
    document is drawn once or not at all, with ``probability`` = ratio over the
    largest ratio, so the expected tokens of every source, language and topic
    are in the target proportions. The draw is a hash of ``seed`` and id, or text where
    the id is null, so it is the same in every run, and rows that share an id
    share the draw. Null sources and languages are a value of their own
    ("(none)"). Documents without tokens have probability 0. An empty table
    gives no rows. Without ``targets`` each margin's shares are tempered.
    Columns of the same names as those added are replaced.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)"))
    added = ["mix_topic", "n_tokens", "ratio", "probability", "sampled", "fit"]
    at = dict(zip(MARGINS, free_names(docs.columns, *[f"_cell_{m}" for m in MARGINS]), strict=True))
    topic = coarse_topic(F.col(text)) if topic is None else topic
    rows = docs.withColumns(
        {at["source"]: named("source"), at["lang"]: named("lang"), at["topic"]: F.coalesce(topic.cast("string"), F.lit("(none)")), "n_tokens": token_count(F.col(text))}
    )
    cells = materialize(
        rows.groupBy(*[F.col(at[m]).alias(m) for m in MARGINS]).agg(F.sum("n_tokens").alias("tokens"))
    )
    targets = targets or {m: tempered(cells, m, temperature) for m in MARGINS}
    raked = rake(cells, targets)
    total = raked.agg(F.sum("tokens").alias("n"))
    ratios = raked.join(F.broadcast(total)).withColumn("ratio", F.col("weight") * F.col("n") / F.col("tokens"))
    top = ratios.agg(F.max("ratio").alias("top"))
    ratios = materialize(ratios.join(F.broadcast(top)).select(
        *[F.col(m).alias(at[m]) for m in MARGINS], "ratio", (F.col("ratio") / F.col("top")).alias("probability")
    ))
    fit = raked.agg(F.max("fit").alias("fit"))  # one row
    if cells.count() <= BROADCAST_CELLS:
        ratios = F.broadcast(ratios)
    rows = rows.drop("ratio", "probability", "sampled", "mix_topic", "fit").join(F.broadcast(fit))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.col(text).cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return (
        rows.join(ratios, list(at.values()), "left")
        .withColumns(
            {
                "mix_topic": F.col(at["topic"]),
                "ratio": F.when(F.col("n_tokens") > 0, F.coalesce("ratio", F.lit(0.0))).otherwise(0.0),
                "probability": F.when(F.col("n_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0),
            }
        )
        .withColumn("sampled", draw < F.col("probability"))
        .select(*[c for c in docs.columns if c not in added], *added)
    )
