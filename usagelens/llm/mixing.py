"""Mixing sources to target weights with Sainte-Laguë apportionment.

A source's target is its weight's share of ``SHARE`` times all words, but at most
``MOST`` times its own; what is above goes to the others by weight. The mix is cut
into equal blocks of ``BLOCK_WORDS`` words. Sainte-Laguë gives each block to the
source with the highest quotient target / (2 k + 1), k being the blocks it has,
and then, the same way, a source's blocks to its shards. A shard lines its
documents up in a seeded order and cuts that line into equal blocks; its quota
takes all of them as often as it holds them whole, and the first ones once more.

A highest-quotient result differs from proportional shares by less than
``1 + n * share / (2 * all)`` for n parties, so only quotients in that range are
ranked: about three rows a party, whatever the number of blocks.

Hot sources: documents are dealt by (source, shard), and a source has a shard for
every ``SHARD_WORDS`` words, up to ``SHARDS``; from there on its shards grow.
Tables with a row per source or per shard of a source are the only ones that a
single task ranks.

Defined cases: a null text has no words, is never taken and does not count; a null
source is a source of its own and comes last; repeated rows are lined up one after
the other; an empty table gives no rows; extra columns are kept by ``mix``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from usagelens.llm import base

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18
SHARDS = 10_000
SEED = 17

WORD = re.compile(r"[^ \t-\r]+")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: its number in code point order, words, weight and target.

    Sources in ascending order of cap / weight: the first k are held at their cap if
    the level that the rest would get, (all - caps) / weights, is above their own.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("number", F.lit(len(weights))).cast("int") + 1)
    cap = (F.col("source_size") * most).cast("double")
    table = sources.withColumn("number", number).withColumn("weight", weight.cast("double")).withColumn("cap", cap)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    whole = share * F.sum("source_size").over(Window.partitionBy())
    levels = table.withColumn("level", (whole - before) / rest)
    free = F.col("cap") >= F.col("level") * F.col("weight")
    level = F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), "number", "level"))).over(Window.partitionBy())["level"]
    return levels.select("source", "number", "source_size", "weight", F.least("cap", F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"))


def apportion(parties: DataFrame, group: str, party: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë in each group: the seats of each party by highest quotients, ties to the lower party.

    parties: a row for each party with its group, votes and the seats of the group.
    """
    own = Window.partitionBy(group)
    v, all_votes, n = F.col(votes).cast("double"), F.sum(F.col(votes).cast("double")).over(own), F.count(F.lit(1)).over(own)
    table = parties.select(group, party, v.alias("v"), F.col(seats).cast("long").alias("s"), all_votes.alias("total"), n.alias("n")).filter("v > 0")
    fair, room = F.col("v") * F.col("s") / F.col("total"), 1 + F.col("n") * F.col("v") / (2 * F.col("total"))
    sure = F.greatest(F.lit(0), F.floor(fair - room)).cast("long")
    table = table.withColumn("sure", sure).withColumn("open", F.col("s") - F.sum(sure).over(own))
    tried = table.withColumn("k", F.explode(F.sequence("sure", F.ceil(fair + room).cast("long"))))
    place = F.row_number().over(Window.partitionBy(group).orderBy((F.col("v") / (2 * F.col("k") + 1)).desc(), party))
    ranked = tried.withColumn("won", (place <= F.col("open")).cast("long"))
    return ranked.groupBy(group, party).agg((F.first("sure") + F.sum("won")).alias("quota"))


def quotas(sizes: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """One row per shard of a source with its words, blocks and the blocks the mix takes."""
    sources = targets(sizes, **how)
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / BLOCK_WORDS).cast("long")
    shards = F.least(F.lit(SHARDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS))).cast("int")
    sources = base.saved(sources.withColumn("blocks", blocks).withColumn("mix", F.lit(0)).withColumn("shards", shards), "sources")
    won = apportion(sources, "mix", "number", "target", "blocks").withColumnRenamed("quota", "seats").drop("mix")
    lines = placed(sizes, sources, seed).groupBy("number", "shard").agg(F.sum("size").alias("line"))
    lines = lines.withColumn("line_blocks", F.when(F.col("line") > 0, F.greatest(F.lit(1), F.round(F.col("line") / BLOCK_WORDS))).otherwise(0).cast("long"))
    lines = lines.join(won, "number", "left").fillna(0, ["seats"])
    given = apportion(lines, "number", "shard", "line_blocks", "seats")
    return sources.drop("mix", "blocks").join(lines.drop("seats"), "number").join(given, ["number", "shard"], "left").fillna(0, ["quota"])


def _order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id")


def placed(sizes: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Rows with the number of their source and a shard."""
    table = sources.select(F.col("source").alias("its_source"), "number", "shards")
    shard = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.col("shards")).cast("int")
    return sizes.join(table, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source").withColumn("shard", shard)


def allocate(rows: DataFrame, seed: int = SEED, sizes: DataFrame | None = None, **how) -> DataFrame:
    """rows (doc_id, source, size, and what else) with source_size, target and taken."""
    table = base.saved(quotas(rows if sizes is None else sizes, seed, **how), "quotas")
    line = Window.partitionBy("number", "shard").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    lined = placed(rows, table.select("source", "number", "shards").distinct(), seed).drop("shards").withColumn("order", _order(seed))
    lined = lined.withColumn("end", F.sum("size").over(line))
    joined = lined.join(table.select("number", "shard", "source_size", "target", "line", "line_blocks", "quota"), ["number", "shard"])
    quota = F.least(F.col("quota"), MOST * F.col("line_blocks"))
    whole = F.when(F.col("line_blocks") > 0, F.floor(quota / F.col("line_blocks"))).otherwise(0).cast("long")
    extra = F.when(F.col("line_blocks") > 0, F.floor((quota - whole * F.col("line_blocks")) * F.col("line") / F.col("line_blocks"))).otherwise(0).cast("long")
    part = F.greatest(F.lit(0), F.least("end", extra) - (F.col("end") - F.col("size")))
    return joined.withColumn("taken", (whole * F.col("size") + part).cast("long"))


def sized(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select("doc_id", "source", base.word_count().alias("size"), *more)


def judge(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """One row per document with what the mix takes of it."""
    rows = allocate(base.saved(sized(docs), "sizes"), seed, **how)
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source", "number")


def mix(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """The mix itself: documents as often as they are taken whole, and one more row with the first words of a part.

    All columns are kept; ``text`` is cut in the parts, and a whole-number column
    ``n_chars``, if there, tells its new length. Texts are shuffled once.
    """
    sizes = base.saved(sized(docs), "sizes")
    rows = allocate(sized(docs, F.struct(*docs.columns).alias("row")), seed, sizes, **how)
    names = docs.columns
    counted = "n_chars" in names and isinstance(docs.schema["n_chars"].dataType, IntegralType)
    types = base.arrow_schema(docs.schema)

    def run(batches):
        for batch in batches:
            size, taken = (np.array(batch.column(c), np.int64) for c in ("size", "taken"))
            whole, part = taken // np.maximum(size, 1), taken % np.maximum(size, 1)
            at = np.repeat(np.arange(len(size)), whole + (part > 0))
            if not len(at):
                continue
            words = np.zeros(len(at), np.int64)
            words[np.cumsum(whole + (part > 0))[part > 0] - 1] = part[part > 0]
            columns = dict(zip(names, batch.column("row").flatten(), strict=True))
            columns = {k: c.take(pa.array(at)) for k, c in columns.items()}
            cut = pa.array(words > 0)
            texts = [first_words(x, n) if n else None for x, n in zip(columns["text"].to_pylist(), words.tolist(), strict=True)] if words.any() else None
            if texts:
                columns["text"] = pc.if_else(cut, pa.array(texts, columns["text"].type), columns["text"])
                if counted:
                    columns["n_chars"] = pc.if_else(cut, pa.array([len(x or "") for x in texts], columns["n_chars"].type), columns["n_chars"])
            yield base.record_batch(list(columns.values()), types)

    return rows.filter("taken > 0").select("size", "taken", "row").mapInArrow(run, docs.schema)


def first_words(text: str, n: int) -> str:
    """text up to the end of its n-th word."""
    end = 0
    for _, m in zip(range(n), WORD.finditer(text), strict=False):
        end = m.end()
    return text[:end]
