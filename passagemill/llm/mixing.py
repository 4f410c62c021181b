"""Mixing sources to target weights by pivotal dependent rounding, without Python.

A document of size w whose source wants r copies of it gets floor(r) copies and
holds the rest as a mass of w * frac(r) words. Two masses of one source meet:
words move from one to the other, in a random direction whose chance keeps every
expectation, until one of the two is empty or full. A full mass is one more copy,
an empty one none; the other goes on. The words of a source are never lost on the
way, so its mix ends within one document of its target. The meetings form a
reduction tree: blocks of ``BLOCK`` masses are folded in parallel, each leaves at
most one open mass, and the open ones are blocks of the next level.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from passagemill.session import broadcast_if_small, materialize

#: Masses folded in one block of the tree (on average), and a source's largest share of its own size.
BLOCK = 64
MOST = 3.0
#: Weights by the place of a source in code-point order (repeating).
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"

_ITEM = "struct<unit:bigint,w:double,mass:double>"
_DONE = "array<struct<unit:bigint,full:boolean,w:double,mass:double,open:boolean>>"


def source_targets(sized: DataFrame, share: float = 1.0, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source: its words, weight and target words.

    Input: source, words. Sources in code-point order, null last, weigh
    ``weights`` in turn. Targets share ``share`` of all words by weight; none is
    above ``most`` times its source's words, and the excess is shared again by
    weight among the others. Each round of sharing is one small aggregate; the
    rounds end when no further source reaches its limit.
    """
    sources = sized.groupBy("source").agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(_by_code_point())
    values = F.array(*map(F.lit, weights))
    sources = materialize(
        sources.withColumn("weight", values[((place - 1) % len(weights)).cast("int")].cast("double")), "mix-sources"
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * most
    level, held = -1.0, -1
    while True:
        full = limit <= F.col("weight") * level
        capped, n, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)), F.count_if(full), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))
        ).first()
        if n == held or not open_weight:
            break
        held, level = n, max(0.0, total * share - capped) / open_weight
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(float(level))))


def _by_code_point():
    # one row per source: the only rows that this order sees
    return W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))


def mix(documents: DataFrame, *, share: float = 1.0, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: int = 17) -> DataFrame:
    """Copies of every document in the mix.

    Input: doc_id, text, source (more columns are ignored). Result: doc_id,
    source, size (words of the text, null 0), source_size, target, copies (whole
    number up to ``most`` rounded up where ``most`` is whole), taken (copies *
    size) and no (number among equal rows), one row per input row. The choice depends on the rows and the seed
    alone. Equal (doc_id, source, size) rows share what falls on them: each takes
    the floor of its share and the first of them one more. Empty documents are
    taken at no cost; a source without words has target 0; null ids and sources
    are values like others; an empty table gives no rows.
    """
    sized = documents.select("doc_id", "source", _size().alias("size"))
    units = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))
    counted = _copies(units, share, weights, most, seed)
    # back to one row per input row: the first of equal rows take the remainder
    each = counted.withColumn("_no", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    share_of = F.floor(F.col("_copies") / F.col("rows"))
    left = F.col("_copies") - share_of * F.col("rows")
    copies = (share_of + F.when(F.col("_no") <= left, 1).otherwise(0)).cast("int")
    return each.withColumn("copies", copies).select(
        "doc_id", "source", "size", F.col("source_size").cast("bigint").alias("source_size"),
        "target", "copies", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), F.col("_no").alias("no"),
    )


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def _copies(units: DataFrame, share: float, weights: tuple[int, ...], most: float, seed: int) -> DataFrame:
    """Units (doc_id, source, size, rows) with ``_copies``, the copies of all their rows together."""
    # equal rows are one unit with a count, so they cannot crowd a block
    units = materialize(units.withColumn("unit", F.xxhash64("doc_id", "source", "size")), "mix-units")
    targets = source_targets(units.select("source", (F.col("size") * F.col("rows")).alias("words")), share, weights, most)
    counts = units.groupBy("source").agg(F.count("*").alias("n"))
    known = targets.join(counts, targets["source"].eqNullSafe(counts["source"])).select(
        targets["source"].alias("_src"), "source_size", "target", "n",
        F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0).alias("rate"),
        F.xxhash64(targets["source"], F.lit(seed)).alias("_key"),
    )
    known = broadcast_if_small(materialize(known, "mix-known"), "_src")
    wanted = F.col("rows") * F.col("rate")
    near = F.round(wanted)  # a whole number up to rounding errors is whole
    wanted = F.when(F.abs(wanted - near) < 1e-9 * F.greatest(wanted, F.lit(1.0)), near).otherwise(wanted)
    ready = units.join(known, units["source"].eqNullSafe(known["_src"])).select(
        "doc_id", "source", "size", "rows", "unit", "source_size", "target", "_key", "n",
        F.floor(wanted).alias("sure"), (wanted - F.floor(wanted)).alias("part"),
    )
    ready = materialize(ready, "mix-ready")
    blocks = F.ceil(F.col("n") / BLOCK)
    start = ready.filter((F.col("part") > 0) & (F.col("size") > 0)).select(
        "_key", blocks.alias("of"), F.pmod("unit", blocks).alias("block"),
        F.struct("unit", F.col("size").cast("double").alias("w"), (F.col("size") * F.col("part")).alias("mass")).alias("item"),
    )
    largest = known.agg(F.max("n")).first()[0] or 0
    chosen, level = None, 0
    depth = max(1, math.ceil(math.log(max(math.ceil(largest / BLOCK), 1), BLOCK)) + 1)
    rows = start
    for level in range(depth):
        folded = materialize(_fold(rows, seed + level, last=level == depth - 1), f"mix-level{level}")
        done = folded.filter("not open").select("unit", "full")
        chosen = done if chosen is None else chosen.unionByName(done)
        rows = folded.filter("open").select(
            "_key", F.ceil(F.col("of") / BLOCK).alias("of"), F.floor(F.col("block") / BLOCK).alias("block"),
            F.struct("unit", "w", "mass").alias("item"),
        )
    # units of one hash share a copy instead of being joined twice
    extra = chosen.filter("full").select(F.col("unit").alias("_unit"), F.lit(1).alias("_one")).dropDuplicates(["_unit"])
    return ready.join(extra, ready["unit"] == extra["_unit"], "left").withColumn(
        "_copies", F.col("sure") + F.coalesce("_one", F.lit(0))
    )


def mixed_documents(
    documents: DataFrame, *, share: float = 1.0, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: int = 17
) -> DataFrame:
    """The rows of the mix: every document as often as ``mix`` takes it, with all its columns.

    Documents that are not taken are left out. Rows that agree in doc_id, source and
    size share their copies evenly; what remains goes to those whose digest of all
    columns is smallest. Digests stand for the rows until the copies are known,
    so texts are read twice but move at most once, in the last join.
    """
    # null columns leave a hash as it is, so their places come in as well
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in documents.columns])
    values = [F.to_json(F.struct(f"`{c.name}`")) if "map<" in c.dataType.simpleString() else F.col(f"`{c.name}`") for c in documents.schema]
    one, two = (F.xxhash64(F.lit(i), nulls, *values) for i in (1, 2))
    narrow = documents.select("doc_id", "source", _size().alias("size"), one.alias("_one_key"), two.alias("_two_key"))
    alike = materialize(
        narrow.groupBy("doc_id", "source", "size", "_one_key", "_two_key").agg(F.count("*").alias("same")), "mix-rows"
    )
    counted = _copies(alike.groupBy("doc_id", "source", "size").agg(F.sum("same").alias("rows")), share, weights, most, seed)
    counted = counted.filter("_copies > 0").select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_w"), "rows", "_copies"
    )
    match = alike["doc_id"].eqNullSafe(counted["_d"]) & alike["source"].eqNullSafe(counted["_s"]) & (alike["size"] == counted["_w"])
    before = W.partitionBy("doc_id", "source", "size").orderBy("_one_key", "_two_key").rowsBetween(W.unboundedPreceding, -1)
    share_of, left = F.floor(F.col("_copies") / F.col("rows")), F.col("_copies") % F.col("rows")
    first = F.coalesce(F.sum("same").over(before), F.lit(0))
    more = F.greatest(F.lit(0), F.least(F.col("same"), left - first))  # of the equal rows, so many take one more
    whole = more == F.col("same")
    taken = materialize(
        alike.join(counted, match).select(
            F.col("_one_key").alias("_a"), F.col("_two_key").alias("_b"),
            (share_of + F.when(whole, 1).otherwise(0)).cast("int").alias("_each"), F.when(whole, 0).otherwise(more).cast("int").alias("_some"),
        ).filter("_each > 0 or _some > 0"),
        "mix-taken",
    )
    names = [f"_c{i}" for i in range(len(documents.columns))]
    rows = documents.select(one.alias("_one_key"), two.alias("_two_key"), *[F.col(f"`{c}`").alias(n) for c, n in zip(documents.columns, names, strict=True)])

    def met(some: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_small(some), (rows["_one_key"] == some["_a"]) & (rows["_two_key"] == some["_b"]))

    every = met(taken.filter("_each > 0")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_each")))).select(*names)
    few = taken.filter("_some > 0")
    if not few.isEmpty():  # some of several equal rows: any of them serves as the original
        once = met(few).groupBy("_a", "_b").agg(F.first("_some").alias("_some"), F.first(F.struct(*names)).alias("_row"))
        every = every.unionByName(
            once.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_some")))).select(*[F.col(f"_row.{n}").alias(n) for n in names])
        )
    return every.toDF(*documents.columns)


def _fold(rows: DataFrame, seed: int, last: bool) -> DataFrame:
    """Fold each block of masses; the rows decided, and the open one unless ``last``."""
    blocks = rows.groupBy("_key", "of", "block").agg(F.array_sort(F.collect_list("item")).alias("items"))

    def result(unit: Column, full: Column, w: Column, mass: Column, open_: Column) -> Column:
        return F.struct(unit.alias("unit"), full.alias("full"), w.alias("w"), mass.alias("mass"), open_.alias("open"))

    def meet(state: Column, item: Column) -> Column:
        mine = state["held"]
        a, b = mine["mass"], item["mass"]
        to_mine = F.least(mine["w"] - a, b)  # words that can go to the one held
        to_item = F.least(a, item["w"] - b)
        up = _uniform(mine["unit"], item["unit"], seed) * (to_mine + to_item) < to_item
        # the side that becomes whole, and what the other then holds
        mine_full = up & (mine["w"] - a <= b)
        item_empty = up & ~mine_full
        item_full = ~up & (item["w"] - b <= a)
        mine_whole = mine_full | (~up & ~item_full)
        rest = F.when(mine_full, b - (mine["w"] - a)).when(item_full, a - (item["w"] - b)).otherwise(a + b)
        settled = result(
            F.when(mine_whole, mine["unit"]).otherwise(item["unit"]), mine_full | item_full, F.lit(0.0), F.lit(0.0), F.lit(False)
        )
        goes_on = F.when(mine_whole, F.struct(item["unit"].alias("unit"), item["w"].alias("w"), rest.alias("mass"))).otherwise(
            F.struct(mine["unit"].alias("unit"), mine["w"].alias("w"), rest.alias("mass"))
        )
        first = mine["unit"].isNull()
        return F.struct(
            F.when(first, item).otherwise(goes_on).cast(_ITEM).alias("held"),
            F.when(first, state["done"]).otherwise(F.concat(state["done"], F.array(settled))).cast(_DONE).alias("done"),
        )

    begin = F.struct(F.lit(None).cast(_ITEM).alias("held"), F.array().cast(_DONE).alias("done"))
    end = blocks.withColumn("_s", F.aggregate("items", begin, meet))
    held = F.col("_s.held")
    if last:
        taken = _uniform(held["unit"], held["unit"], seed) * held["w"] < held["mass"]
        final = result(held["unit"], taken, F.lit(0.0), F.lit(0.0), F.lit(False))
    else:
        final = result(held["unit"], F.lit(False), held["w"], held["mass"], F.lit(True))
    out = end.select("_key", "of", "block", F.explode(F.concat("_s.done", F.array(final).cast(_DONE))).alias("_r"))
    return out.select("_key", "of", "block", "_r.*")


def _uniform(one: Column, two: Column, seed: int) -> Column:
    """A number from 0 to below 1, fixed by the two units and the seed."""
    return F.pmod(F.xxhash64(one, two, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
