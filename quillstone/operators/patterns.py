"""Groups of blocks with equal text or equal place and font, and rules applied to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import collapse, position_key

LEAST_MEMBERS, SAMPLE, SUMMARY = 2, 50, 200


def text_key() -> Column:
    return collapse(F.col("text"))


def place_key() -> Column:
    return position_key(F.col("bbox")["y0"], F.col("font_size"), F.col("font_name"), F.col("is_bold"), F.col("is_italic"), F.col("region"))


def groups(blocks: DataFrame, key: Column) -> DataFrame:
    """doc_id, key, n, members (in document order); groups of one are left out."""
    g = blocks.groupBy("doc_id", key.alias("key")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("page", "reading_order_index", "block_id"))).alias("m"))
    return g.where(F.col("n") >= LEAST_MEMBERS).select("doc_id", "key", "n", F.transform("m", lambda x: x["block_id"]).alias("members"))


def membership(blocks: DataFrame, key: Column) -> DataFrame:
    """block_id, doc_id, key, n: the key and size of its group, 1 for a block alone; the members stay in the table of groups."""
    sizes = blocks.groupBy(F.col("doc_id").alias("of_doc"), key.alias("of_key")).agg(F.count("*").alias("n"))
    keyed = blocks.select("block_id", "doc_id", key.alias("key"))
    return keyed.join(sizes, (F.col("doc_id") == F.col("of_doc")) & F.col("key").eqNullSafe(F.col("of_key"))).select("block_id", "doc_id", "key", "n")


def members(chosen: DataFrame, blocks: DataFrame, key: Column) -> DataFrame:
    """block_id, members: for each of chosen (block_id) the blocks of its group, or itself alone."""
    mine = blocks.select("block_id", "doc_id", key.alias("key")).join(chosen.select("block_id").distinct(), "block_id", "left_semi")
    g = groups(blocks, key).select(F.col("doc_id").alias("of_doc"), F.col("key").alias("of_key"), "members")
    return mine.join(g, (F.col("doc_id") == F.col("of_doc")) & (F.col("key") == F.col("of_key")), "left").select("block_id", F.coalesce("members", F.array("block_id")).alias("members"))


def samples(grouped: DataFrame, most: int = SAMPLE) -> DataFrame:
    return grouped.select("doc_id", "key", F.slice("members", 1, most).alias("shown"), F.greatest(F.col("n") - most, F.lit(0)).alias("more"))


def summaries(blocks: DataFrame) -> DataFrame:
    return blocks.select("block_id", F.substring("text", 1, SUMMARY).alias("text"), "page", "font_size", "region")


def apply_rules(blocks: DataFrame, rules: DataFrame) -> DataFrame:
    """block_id, suppressed, tag; rules: block_id, action (suppress or tag), tag, ord: the last of each action counts."""
    last = rules.groupBy("block_id").agg(F.max_by(F.col("on"), F.when(F.col("action") == "suppress", F.col("ord"))).alias("s"), F.max_by("tag", F.when(F.col("action") == "tag", F.col("ord"))).alias("tag"))
    return blocks.select("block_id").join(last, "block_id", "left").select("block_id", F.coalesce("s", F.lit(False)).alias("suppressed"), "tag")


def decision_counts(blocks: DataFrame, state: DataFrame) -> DataFrame:
    """doc_id, suppressed, tagged: how many blocks of each document are."""
    each = blocks.select("doc_id", "block_id").join(state, "block_id")
    return each.groupBy("doc_id").agg(F.count_if("suppressed").alias("suppressed"), F.count("tag").alias("tagged"))


def ids_by_tag(blocks: DataFrame, state: DataFrame) -> DataFrame:
    """doc_id, tag, ids in the order of their names (p10 before p2)."""
    each = blocks.select("doc_id", "block_id").join(state.where("tag is not null"), "block_id")
    return each.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_list("block_id")).alias("ids"))


def group_state(grouped: DataFrame, state: DataFrame) -> DataFrame:
    """doc_id, key, all_suppressed, common_tag (null if members differ)."""
    each = grouped.select("doc_id", "key", "n", F.explode("members").alias("block_id")).join(state, "block_id")
    common = F.when((F.min("tag") == F.max("tag")) & (F.count("tag") == F.first("n")), F.min("tag"))
    return each.groupBy("doc_id", "key").agg(F.bool_and("suppressed").alias("all_suppressed"), common.alias("common_tag"))
