"""Mixing sources to target weights, exactly and reproducibly.

Every document gets a hash-random key.  Equal (source, key, doc_id, size) rows
are counted into one unit, the units are range-sorted within their source, and
distributed prefix sums of the word counts find the one unit in which each
source's budget ends.  What a document gives then follows from comparing its
own key with its source's cut, so texts are never shuffled.

A source's budget is ``epochs`` whole passes plus a remainder: units before the
cut give one pass more, the unit at the cut gives the rest of the remainder,
to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odometer.llm.common import SPACE, WORD, fresh, ordinals, same, stash

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20260


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: tuple = WEIGHTS, most: float = MAX_EPOCHS) -> DataFrame:
    """Targets of sources (source, source_size), one row each: ``weights``
    repeat over the sources in code point order, null last; all sizes together
    are shared by weight, no target is above ``most`` times its source's size,
    and what that frees is shared anew by weight until none is above."""
    totals = stash(totals.withColumn("unnamed", F.col("source").isNull()), "sources")
    ranked = ordinals(totals, ["unnamed", "source"], "rank", "source-ranks")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = stash(ranked, "weighted")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * F.lit(float(most))
    share = 0.0
    while True:
        # Sources whose share is above their cap give it back; those stay so,
        # as the share only grows.
        above = F.col("weight") * F.lit(share) > cap
        fixed, free = ranked.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))
        ).first()
        new = (total - fixed) / free if free else share
        if new <= share:
            break
        share = new
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(share), cap).alias("target"))


def mix_plan(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, source) with a struct
    ``mix`` (size, source_size, target, taken, copies, part): ``taken`` words
    are ``copies`` whole passes and the first ``part`` words once more.

    Null text has size 0; null source is a source of its own.  A source of size
    0 has target 0.  Rows equal in doc_id, source and text share a cut that
    falls on them evenly, each rounded down.  An empty table gives no rows.
    """
    (mix,) = fresh(docs, "mix")
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    keyed = docs.withColumn(
        mix, F.struct(key.alias("key"), n_words(F.col("text")).alias("size"), F.col("doc_id").alias("doc_id"))
    )
    units = keyed.groupBy(F.col("source").alias("source"), F.col(mix).alias("unit")).agg(F.count(F.lit(1)).alias("m"))
    units = stash(
        units.select("source", "unit.key", "unit.doc_id", "unit.size", "m", (F.col("unit.size") * F.col("m")).alias("words")),
        "units",
    )
    targets = stash(
        source_targets(units.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most), "targets"
    )

    # Prefix sums: numbered in order, cut into stretches of a fixed number of
    # units; totals of stretches, then sums inside the one that holds the cut.
    order = ["source", "key", "doc_id", "size"]
    dealt = ordinals(units, order, "nth", "mix-order").withColumn("stretch", F.expr("nth div 4096"))
    dealt = stash(dealt, "mix-sorted")
    cells = dealt.groupBy("source", "stretch").agg(F.sum("words").alias("cell"))
    before = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("ahead", F.coalesce(F.sum("cell").over(before), F.lit(0)))
    size = F.col("source_size")
    budget = F.floor("target").cast("long")
    plan = targets.withColumn("epochs", F.when(size > 0, F.floor(budget / size)).otherwise(0).cast("long"))
    plan = plan.withColumn("left", F.when(size > 0, budget - F.col("epochs") * size).otherwise(0).cast("long"))
    c, p = cells.alias("c"), plan.alias("p")
    hit = c.join(p, same(F.col("c.source"), F.col("p.source"))).filter(
        (F.col("left") > F.col("ahead")) & (F.col("left") <= F.col("ahead") + F.col("cell"))
    )
    hit = hit.select(F.col("c.source").alias("h_source"), F.col("c.stretch").alias("h_stretch"), "ahead", "left")
    inside = dealt.join(hit, same(dealt["source"], hit["h_source"]) & (dealt["stretch"] == hit["h_stretch"]))
    run = Window.partitionBy("source", "stretch").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("sofar", F.col("ahead") + F.coalesce(F.sum("words").over(run), F.lit(0)))
    cut = inside.filter((F.col("left") > F.col("sofar")) & (F.col("left") <= F.col("sofar") + F.col("words")))
    cut = cut.select(
        F.col("source").alias("c_source"),
        F.struct("key", "doc_id", F.col("size").alias("size")).alias("at"),
        F.expr("(left - sofar) div m").alias("at_words"),
    )
    # What the plan says of a source is one struct, named like no column of ``docs``.
    told, p_source = fresh(keyed, "plan", "p_source")
    plan = plan.join(cut, same(plan["source"], cut["c_source"]), "left").select(
        F.col("source").alias(p_source), F.struct("source_size", "target", "epochs", "at", "at_words").alias(told)
    )
    plan = stash(plan, "mix-plan")

    joined = keyed.join(plan, same(keyed["source"], plan[p_source]), "left")
    at = F.col(f"{told}.at")
    own = F.struct(F.col(f"{mix}.key").alias("key"), F.col(f"{mix}.doc_id").alias("doc_id"), F.col(f"{mix}.size").alias("size"))
    words = F.col(f"{mix}.size")
    more = F.when(at.isNull() | (own > at), 0).when(own == at, F.col(f"{told}.at_words")).otherwise(words)
    more = more.cast("long")
    whole = (words > 0) & (more >= words)
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(
            words.alias("size"),
            F.col(f"{told}.source_size").alias("source_size"),
            F.col(f"{told}.target").alias("target"),
            (F.col(f"{told}.epochs") * words + more).alias("taken"),
            (F.col(f"{told}.epochs") + whole.cast("long")).alias("copies"),
            F.when(whole, F.lit(0)).otherwise(more).cast("long").alias("part"),
        ).alias(mix),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: each row as often as
    the plan takes it whole, and the row in which a source's budget ends once
    more with the first words that the plan takes (``n_chars``, where there,
    follows the text).  Rows without words belong to every pass."""
    planned = mix_plan(docs, **options)
    mix = planned.columns[-1]
    part, text = F.col(f"{mix}.part"), F.col("text")
    # Null for a whole pass, else the words of a cut one.
    passes = F.concat(
        F.array_repeat(F.lit(None).cast("long"), F.col(f"{mix}.copies").cast("int")),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<long>")),
    )
    (cut,) = fresh(planned, "cut")
    out = planned.withColumn(cut, F.explode(passes))
    # Cut after that many words; a cut falls on one row per source.
    words = F.split(F.regexp_replace(text, f"^{SPACE}+", ""), f"(?<=[^\\x20\\x09-\\x0D])(?={SPACE})")
    short = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col(cut), F.lit(1)).cast("int")), "")
    text_out = F.when(F.col(cut).isNull(), text).otherwise(short)
    named = {"text": text_out}
    if "n_chars" in docs.columns:
        n = F.when(F.col(cut).isNull(), F.col("n_chars")).otherwise(F.length(short).cast(docs.schema["n_chars"].dataType))
        named["n_chars"] = n
    return out.select(*[named[c].alias(c) if c in named else F.col(f"`{c}`") for c in docs.columns])
