"""Chat formatting: logged snapshots of a conversation collapse into the longest.

A chat log often holds a conversation many times, once after every turn.  Each
conversation gets rolling hashes of its turn prefixes: position k has the sum of
the hashes of turns 1 to k, each hashed with its position, role and text (two
64-bit hashes, summed exactly, so about 128 bits tell sequences apart).  The
hash of a whole conversation among the hashes of proper prefixes means that a
longer conversation starts with it: an anti-join leaves the maximal ones.  Equal
conversations leave the smallest conv_id, with their number.

All is counting and joining of hashes.  A first turn, or a whole conversation,
that a third of the log shares is one row after the pre-aggregation.  Texts are
gathered once, per conversation, for those that are kept; a conversation is one
output row and so must fit one, like any document.

Edge cases: turns are ordered by turn, role, text (nulls first); a null role or
text is an empty one; identical rows of a conversation count once; rows without
conv_id belong to no conversation and are left out; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rowmill.llm.base import stage

TEMPLATE = ("<|{}|>\n", "\n<|end|>\n")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without repeated rows and gaps."""
    return conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()


def prefix_hashes(rows: DataFrame) -> DataFrame:
    """conv_id, position, last (whether it is the whole conversation), two sums."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select(
        "conv_id", "turn", "role", "text", F.row_number().over(order).alias("position"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"),
    )
    hashes = [
        F.xxhash64("position", "role", "text", F.lit(seed)).cast("decimal(20,0)").alias(f"h{seed}")
        for seed in (1, 2)
    ]
    so_far = W.partitionBy("conv_id").orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    return numbered.select("conv_id", "position", "last", *hashes).select(
        "conv_id", "position", "last", *[F.sum(f"h{s}").over(so_far).alias(f"h{s}") for s in (1, 2)]
    )


def maximal(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_logged (equal ones) of conversations to keep."""
    key = ["position", "h1", "h2"]
    prefixes = stage(prefix_hashes(rows), "prefixes")
    whole = prefixes.where("last").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_logged")
    )
    proper = prefixes.where("NOT last").select(*key).distinct()
    return whole.join(proper, key, "left_anti").select(
        "conv_id", F.col("position").cast("long").alias("n_turns"), "n_logged"
    )


def render(conversations: DataFrame, template: tuple[str, str] = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, n_logged and the text of every maximal conversation."""
    before, after = template
    head, _, tail = before.partition("{}")
    rows = stage(turns(conversations), "turns")
    kept = maximal(rows)
    one = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    texts = rows.groupBy("conv_id").agg(
        F.array_join(
            F.transform(one, lambda t: F.concat(F.lit(head), t.role, F.lit(tail), t.text, F.lit(after))), ""
        ).alias("text")
    )
    return kept.join(texts, "conv_id").select("conv_id", "n_turns", "n_logged", "text")


def digest(rendered: DataFrame) -> DataFrame:
    return rendered.select(
        "conv_id", "n_turns", "n_logged", F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )
