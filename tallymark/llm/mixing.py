"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target t and size s is wanted t / s times. The whole copies are
certain; the fraction is a probability. Two fractional documents are paired and mass is moved
between them, in words, until one of them is integral: to which side is drawn so that each keeps
its expected number of copies, while their words together do not change. Pairs are
taken in chunks of bounded size; the one fraction a chunk can leave goes up to the next level of a
reduction tree, until a source has a single fraction, which is drawn. So each source's words
differ from its target by less than the size of one document (and none is copied more than
``most`` times).

Defined cases: null and word-free texts have size 0 and weigh nothing; a null source is a source of its
own, last in the order of weights; rows with equal ids are rows of their own; an empty table gives
an empty table; draws come from a hash of id, size and seed, so a rerun gives the same rows.
Columns named like a result column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.plans.lineage import settle
from tallymark.plans.scan import ordered_chunks, running, unchunk

# Blank characters are space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows a task takes at a time: documents of a chunk, and chunks that meet at the next level.
CHUNK, FAN_IN = 4096, 64


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: ``site`` (a struct of it), ``source_size``, ``target`` and ``n`` rows.

    Words wanted of each source: ``share`` of all words by weight, none above ``most`` times its
    size; what is cut off goes to the others by weight, until none is above. ``weights`` repeat over the sources
    by code point, null last. Sources stay a table: each round brings counts and whole sums of it to the driver.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ordered = ordered_chunks(sums.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"])
    turn = F.col("_turn") % len(weights)
    sites = unchunk(running(ordered, [], {"_turn": F.lit(1)})).select(
        F.struct("source").alias("site"), "source_size", "n", turn.cast("int").alias("kind"),
        F.get(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")).alias("weight"),
    )
    sites = settle(sites, "sources")

    def above(unit: float) -> Column:
        return F.col("weight") * F.lit(unit) > F.lit(float(most)) * F.col("source_size")

    total = sites.agg(F.sum("source_size")).first()[0] or 0
    unit, cut = 0.0, -1
    while True:
        # the unit grows with every source cut off, so those cut off before are above it again
        over = above(unit)
        found = sites.where("source_size > 0").agg(
            F.count_if(over).alias("cut"), F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)).alias("words"),
            *[F.count_if(~over & (F.col("kind") == k)).alias(f"n{k}") for k in range(len(weights))],
        ).first()
        left = sum(w * found[f"n{k}"] for k, w in enumerate(weights))
        if found["cut"] == cut or not left:
            break
        cut, unit = found["cut"], (share * total - most * found["words"]) / left
    wanted = F.when(above(unit), F.lit(float(most)) * F.col("source_size")).otherwise(F.col("weight") * F.lit(unit))
    wanted = F.when(F.col("source_size") > 0, wanted).otherwise(0.0)
    return sites.select("site", "source_size", wanted.alias("target"), "n")


def round_chunk(frac: np.ndarray, size: np.ndarray, draws: np.ndarray, last: bool) -> np.ndarray:
    """Pivotal rounding of one chunk in the given order: the fractions after it, all integral but
    at most one, and that one drawn as well if ``last``.
    """
    frac = frac.tolist()
    sizes, draws = size.tolist(), draws.tolist()
    held = -1
    for j, f in enumerate(frac):
        if not 0.0 < f < 1.0:
            continue
        if held < 0:
            held = j
            continue
        a, b, sa, sb = frac[held], f, sizes[held], sizes[j]
        up = min((1.0 - a) * sa, b * sb)  # words that can move from j to held
        down = min(a * sa, (1.0 - b) * sb)
        move = up if draws[j] * (up + down) < down else -down
        # what is moved to its end is set to it exactly
        a_ends, b_ends = ((1.0 - a) * sa <= b * sb, b * sb <= (1.0 - a) * sa) if move > 0 else (a * sa <= (1.0 - b) * sb, (1.0 - b) * sb <= a * sa)
        frac[held] = (1.0 if move > 0 else 0.0) if a_ends else a + move / sa
        frac[j] = (0.0 if move > 0 else 1.0) if b_ends else b - move / sb
        if b_ends and not a_ends:
            continue
        held = -1 if b_ends else j
    if last and held >= 0:
        # the upper bits of its draw have decided a pair already
        frac[held] = 1.0 if draws[held] * 2.0**26 % 1.0 < frac[held] else 0.0
    return np.array(frac)


def _settle_chunk(group: pd.DataFrame) -> pd.DataFrame:
    # long documents first: what is left at the end is short
    group = group.sort_values(["size", "draw", "doc_id", "turn"], ascending=[False, True, True, True], na_position="last", kind="stable")
    last = bool((group["n_chunks"] == 1).all())
    group["frac"] = round_chunk(
        group["frac"].to_numpy(), group["size"].to_numpy().astype(float), group["draw"].to_numpy(), last
    )
    return group


def mix_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 0,
) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, copies``, and ``turn``, its number among equal rows.

    ``weights`` repeat over the sources by code point, null last.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size")
    )
    # rows equal in all of this are interchangeable: numbered from their count, they get draws of their own
    rows = settle(rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("_n")).select(
        "doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("turn")
    ), "sizes")
    plan = source_targets(rows, weights, share, most).withColumn("n_chunks", F.ceil(F.col("n") / F.lit(CHUNK)))
    # its size is known to the planner, which broadcasts it if it is small
    plan = settle(plan.drop("n"), "plan")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.struct("doc_id", "size", "turn")

    def unit(level: int) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), key), 11) * F.lit(2.0**-53)

    placed = rows.withColumn("site", F.struct("source")).join(plan, "site").withColumn("_rate", rate)
    placed = placed.select(
        "doc_id", "source", "size", "turn", "source_size", "target", "n_chunks",
        F.pmod(F.xxhash64(F.lit(~seed), key), F.col("n_chunks")).alias("chunk"), unit(0).alias("draw"),
        F.floor("_rate").cast("long").alias("copies"),
        F.when(F.col("size") > 0, F.col("_rate") - F.floor("_rate")).otherwise(0.0).alias("frac"),
    )
    done, level, depth, chunks = [], placed, 0, plan.agg(F.max("n_chunks")).first()[0] or 1
    while True:
        keyed = level.withColumn("_site", F.struct("source"))
        out = settle(
            keyed.groupBy("_site", "chunk").applyInPandas(
                lambda g: _settle_chunk(g).drop(columns="_site"), level.schema
            ), "rounded",
        )
        whole = (F.col("frac") == 0.0) | (F.col("frac") == 1.0)
        done.append(out.where(whole))
        if chunks == 1:
            break
        # one row per chunk at most goes up
        depth += 1
        level = out.where(~whole).withColumns({
            "draw": unit(depth),
            "chunk": F.floor(F.col("chunk") / FAN_IN).cast("long"),
            "n_chunks": F.ceil(F.col("n_chunks") / FAN_IN).cast("long"),
        })
        chunks = -(-chunks // FAN_IN)
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("copies") + F.col("frac").cast("long")).alias("copies"), "turn"
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of the input.

    Rows equal in id, source and size are interchangeable: the i-th of them gets the i-th number.
    """
    numbers = mix_copies(docs, doc_id, text, source, **how).select(F.struct("doc_id", "source", "size").alias("key"), "turn", "copies")
    key = F.struct(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size")
    )
    # the whole row in one column, so that its names meet none of ours
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    # texts are dealt out once, by key; only those of equal keys are dealt again, by turn
    each = numbers.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("most")).where("most > 0")
    found = rows.join(each, "key")
    several = found.where("n > 1").select(
        "row", "key", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row"))).alias("turn")
    )
    taken = found.where("n = 1").select("row", F.col("most").alias("copies")).unionByName(
        several.join(numbers.where("copies > 0"), ["key", "turn"]).select("row", "copies")
    )
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
