"""Sources mixed to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import packed, same, settled, uniform
from tagloom.operators.indexing import global_positions

WEIGHTS, SHARE, MAX_REPEATS = (3, 1, 2), 1.5, 2
BLOCK = 64  # documents that are rounded against each other in one step of the tree
HEAVY = 0.01  # documents with at least this share of their source's words, 100 at most, are rounded before the others


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeats: float) -> DataFrame:
    """``(_source, _words, _units)`` with ``_target``.

    Sources in code point order, null last, get the ``weights`` in turn. The target is the smaller of
    ``max_repeats`` times the source's words and weight times a level that all sources share. Raising the
    level is the same as resharing what is above a cap by weight: a round adds up the capped sources and
    the weights of the others, one row, and there are as many rounds as resharings.
    """
    order = [F.col("_source").isNull().alias("_last"), "_source", "_words", "_units"]
    placed = global_positions(sizes.select(*order), ["_last", "_source"])
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("start") % len(weights))
    table = settled(
        placed.select("_source", "_words", "_units", weight.alias("_weight"), (F.col("_words") * float(max_repeats)).alias("_cap"))
    )
    level, wanted = 0.0, None
    while True:
        full = F.col("_weight") * level >= F.col("_cap")
        row = table.agg(
            F.sum("_words"), F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight"))), F.count(F.when(full, 1))
        ).first()
        wanted = share * (row[0] or 0)
        if not row[2]:
            break
        if (higher := (wanted - (row[1] or 0.0)) / row[2]) <= level:
            break
        level = higher
    return table.withColumn("_target", F.least("_cap", F.col("_weight") * level))


def _fold(level: int, seed: int) -> tuple[Column, Column]:
    """Of the items of a block: the array of settled ones, and the one that is still open.

    Items are rounded in turn against the one left over from before. Words move between the two, either
    way, until one of them has a copy or none. The chances of the two ways are such that each item's
    expected copies stay what they were, and the block's words stay what they were in every case.
    """
    done_type = "array<struct<unit:{unit},extra:int>>"

    def merge(state: Column, b: Column) -> Column:
        a = state["open"]
        up = F.least(a["mass"] * (1 - a["p"]), b["mass"] * b["p"])
        down = F.least(a["mass"] * a["p"], b["mass"] * (1 - b["p"]))
        luck = uniform(F.lit(seed), F.lit(level), a["mark"], b["mark"])

        def moved(m: Column) -> Column:
            to_a = m["luck"] * (m["up"] + m["down"]) < m["down"]
            a_ends = F.when(to_a, a["mass"] * (1 - a["p"]) <= m["up"]).otherwise(a["mass"] * a["p"] <= m["down"])
            words_to_a = F.when(to_a, m["up"]).otherwise(-m["down"])

            def left(x: Column, gain: Column) -> Column:
                p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), x["p"] + gain / x["mass"]))
                return F.struct(x["unit"].alias("unit"), x["mark"].alias("mark"), x["mass"].alias("mass"), p.alias("p"))

            extra = F.when(a_ends == to_a, 1).otherwise(0)
            settled_one = F.struct(F.when(a_ends, a["unit"]).otherwise(b["unit"]).alias("unit"), extra.alias("extra"))
            return F.struct(
                F.array_append(state["done"], settled_one).alias("done"),
                F.when(a_ends, left(b, -words_to_a)).otherwise(left(a, words_to_a)).alias("open"),
            )

        once = F.array(F.struct(up.alias("up"), down.alias("down"), luck.alias("luck")))
        return F.element_at(F.transform(once, moved), 1)

    return merge, done_type


def _folded(items: DataFrame, blocks: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """``items`` of ``(_source, _block, unit, mark, mass, p)``, folded up a tree of blocks.

    Returns ``(unit, extra)`` of all that are settled, and of each source the one that is still open.
    """
    unit = items.schema["unit"].dataType.simpleString()
    settled_units, level = [], 0
    while True:
        merge, done_type = _fold(level, seed)
        start = F.struct(
            F.array().cast(done_type.format(unit=unit)).alias("done"), F.get("items", F.lit(0)).alias("open")
        )
        block = (
            items.groupBy("_source", "_block")
            .agg(F.sort_array(F.collect_list(F.struct("mark", "unit", "mass", "p"))).alias("items"))
            .select("_source", "_block", F.transform("items", lambda x: F.struct(x["unit"].alias("unit"), x["mark"].alias("mark"), x["mass"].alias("mass"), x["p"].alias("p"))).alias("items"))
            .select("_source", "_block", F.aggregate(F.slice("items", F.lit(2), F.size("items")), start, merge).alias("state"))
        )
        block = settled(block)
        settled_units.append(block.select(F.explode("state.done").alias("x")).select("x.unit", "x.extra"))
        items = block.select("_source", F.floor(F.col("_block") / BLOCK).alias("_block"), "state.open.*")
        if blocks <= 1:
            break
        blocks, level = math.ceil(blocks / BLOCK), level + 1
    out = settled_units[0]
    for more in settled_units[1:]:
        out = out.unionByName(more)
    return out, items


def _last(items: DataFrame, seed: int) -> DataFrame:
    """``(unit, extra)``: an open item alone is taken with its own chance."""
    taken = uniform(F.lit(seed), F.lit(-1), F.col("mark")) < F.col("p")
    return items.select("unit", F.when(taken, 1).otherwise(0).alias("extra"))


def _against_the_rest(heavy: DataFrame, rest: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """One more step of the rounding, in each source: its open heavy item against all its light ones as one.

    The light ones have the same chance, so together they are an item of their mass, ``(_from, _mass, _chance)``. Words move
    between the two until the heavy one has a copy or none, or all light ones have; as in `_fold`, the chances of the
    two ways keep everybody's expected copies. Returns the heavy items with their new chance, 0 or 1 in the first case,
    and ``(_from, _chance)``, the new chance of the light ones.
    """
    both = heavy.join(rest, same(F.col("_source"), F.col("_from")))
    up = F.least(F.col("mass") * (1 - F.col("p")), F.col("_mass") * F.col("_chance"))
    down = F.least(F.col("mass") * F.col("p"), F.col("_mass") * (1 - F.col("_chance")))
    luck = uniform(F.lit(seed), F.lit(-3), F.col("mark")) * (up + down)
    both = both.withColumn("_words", F.when(luck < down, up).otherwise(-down))

    def moved(p: Column, gain: Column, mass: Column) -> Column:
        # What is used up by a move is 0 or 1, whatever the roundings.
        x = p + gain / mass
        return F.when(x < 1e-9, F.lit(0.0)).when(x > 1 - 1e-9, F.lit(1.0)).otherwise(x)

    both = both.withColumn("p", moved(F.col("p"), F.col("_words"), F.col("mass")))
    both = settled(both.withColumn("_chance", moved(F.col("_chance"), -F.col("_words"), F.col("_mass"))))
    alone = heavy.join(rest, same(F.col("_source"), F.col("_from")), "left_anti")
    return both.select(*heavy.columns).unionByName(alone), both.select("_from", "_chance")


def mixing_plan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_repeats: float = MAX_REPEATS,
    seed: int = 1,
) -> DataFrame:
    """How often the mix takes each document: ``(_id, _source, _size, _rows, _words, _target, _copies)``.

    A document's copies are the whole part of target / words of its source, and one more for some. Which
    ones is decided by pivotal rounding up a tree: blocks of about 64 documents of a source settle all of
    theirs but one, whose open rest meets those of 63 other blocks, and so on. Each step is one
    aggregation over the open rests, so a source with most of the rows is many blocks. At the end of the
    tree each source has one open document, and its words differ from the target by less than that
    document's. As the largest documents stay open longest, those with 1 % of their source's words or
    more are rounded first, and the last of them against all light ones as one item (`_against_the_rest`), so
    that the open document is a light one wherever the light ones can make up for it. Every step keeps
    every document's expected copies, so each is target / words times in the mix on average.

    Rows with the same id, source and size are one unit of ``_rows`` rows with the same copies. Null ids,
    null sources and null texts are values like others; a null text has no words. Documents without words
    change no source's words; they are rounded on their own, and have one copy in a source without any
    words. All choices depend on ids and the seed alone. Other columns are not read.
    """
    units = docs.select(
        F.col(id_column).alias("_id"), F.col(source_column).alias("_source"), words(F.col(text_column)).alias("_size")
    )
    units = settled(units.groupBy("_id", "_source", "_size").agg(F.count(F.lit(1)).alias("_rows")))
    sizes = units.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_rows")).alias("_words"), F.count(F.lit(1)).alias("_units"))
    targets = settled(source_targets(sizes, weights, share, max_repeats))
    named = targets.select(F.col("_source").alias("_of"), "_words", "_units", "_target")
    units = units.join(named, same(F.col("_source"), F.col("_of"))).drop("_of")
    rate = F.when(F.col("_words") > 0, F.col("_target") / F.col("_words")).otherwise(F.lit(1.0))
    units = units.withColumn("_whole", F.floor(rate).cast("int")).withColumn("p", rate - F.floor(rate))
    units = units.withColumn("mark", F.xxhash64(F.lit(seed), F.col("_id").cast("string"), F.col("_size")))
    open_ones = (F.col("p") > 0) & (F.col("_size") > 0)
    own = F.when(uniform(F.lit(seed), F.lit(-2), F.col("mark")) < F.col("p"), 1).otherwise(0)
    plain = units.where(~open_ones).withColumn("_copies", F.col("_whole") + F.when(F.col("p") > 0, own).otherwise(0))
    columns = ["_id", "_source", "_size", "_rows", "_words", "_target"]
    largest = targets.agg(F.max("_units")).first()[0] or 0
    blocks = F.ceil(F.col("_units") / BLOCK)
    items = units.where(open_ones).select(
        "_source",
        F.pmod(F.col("mark"), blocks).alias("_block"),
        F.struct(*columns, "_whole").alias("unit"),
        "mark",
        (F.col("_size") * F.col("_rows")).cast("double").alias("mass"),
        "p",
        (F.col("_size") * F.col("_rows") >= F.col("_words") * HEAVY).alias("_heavy"),
    )
    heavy = items.where("_heavy").withColumn("_block", F.lit(0).cast("long")).drop("_heavy")
    heavy_settled, heavy_open = _folded(heavy, 1, seed)
    light = items.where(~F.col("_heavy")).drop("_heavy")
    rest = light.groupBy(F.col("_source").alias("_from")).agg(F.sum("mass").alias("_mass"), F.max("p").alias("_chance"))
    heavy_open, chances = _against_the_rest(heavy_open, rest, seed)
    light = light.join(chances, same(F.col("_source"), F.col("_from")), "left")
    light = light.withColumn("p", F.coalesce("_chance", "p")).drop("_from", "_chance")
    light_settled, light_open = _folded(light, math.ceil(largest / BLOCK), seed)
    heavy_tree = heavy_settled.unionByName(_last(heavy_open, seed))
    light_tree = light_settled.unionByName(_last(light_open, seed))
    tree = heavy_tree.unionByName(light_tree).select("unit.*", "extra")
    return plain.select(*columns, "_copies").unionByName(
        tree.select(*columns, (F.col("_whole") + F.col("extra")).alias("_copies"))
    )


def mix_sources(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as `mixing_plan` says."""
    plan = mixing_plan(docs, id_column, text_column, source_column, **options).select(
        F.col("_id"), F.col("_source"), F.col("_size"), "_copies"
    )
    work = packed(docs, F.col(id_column).alias("_of"), F.col(source_column).alias("_from"), words(F.col(text_column)).alias("_n"))
    on = same(F.col("_of"), F.col("_id")) & same(F.col("_from"), F.col("_source")) & (F.col("_n") == F.col("_size"))
    taken = work.join(plan.hint("shuffle_hash"), on).where(F.col("_copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
