"""Policy views, supporting blocks, backlogs, catalogue grids and ledgers rebuilt from packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators import vocabulary
from docloom.operators.fields import UNLIMITED, text_of

#: Order of backlog priorities, any other comes last; blocks shorter than this support nothing.
PRIORITIES, SHORT = {"high": 0, "medium": 1, "low": 2, "none": 3}, 20


def policy_views(rows: DataFrame, policy: str, group: str, content: str, curated: Column, most: int = UNLIMITED) -> DataFrame:
    """(policy, n_groups, n_contents, n_visible, n_curated, n_provisional, projection): a row for each policy with matched rows.

    ``projection`` is curated or provisional where all contents are, else
    mixed; ``most`` bounds the rows shown, ``UNLIMITED`` or more shows all.
    """
    by = rows.groupBy(policy).agg(F.count_distinct(group).alias("n_groups"), F.count(content).alias("n_contents"), F.count_if(curated).alias("n_curated"))
    n, done = F.col("n_contents"), F.col("n_curated")
    shown = n if most >= UNLIMITED else F.least(n, F.lit(most).cast("long"))
    kind = F.when(done == 0, "provisional").when(done == n, "curated").otherwise("mixed")
    return by.select(policy, "n_groups", "n_contents", shown.alias("n_visible"), "n_curated", (n - done).alias("n_provisional"), kind.alias("projection"))


def bucket_signals(rows: DataFrame, matched: Column, keys: list[str], group: str, content: str) -> DataFrame:
    """(keys, n_groups, n_contents, n_matched_groups, n_matched_contents) of each bucket, in one pass; a bucket without a match has zeros."""
    hit = lambda c: F.when(matched, F.col(c))
    return rows.groupBy(*keys).agg(
        F.count_distinct(group).alias("n_groups"), F.count(content).alias("n_contents"), F.count_distinct(hit(group)).alias("n_matched_groups"), F.count(hit(content)).alias("n_matched_contents")
    )


def selected_or_first(rows: DataFrame, by: str, wanted: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """(by, key, found): in each group the wanted key if the group has it, else its first one by ``order``.

    ``wanted`` has (by, key); a null key, or one that the group lacks, falls
    back.  A group without rows isn't there.
    """
    have = rows.select(by, key, F.struct(*order).alias("__o"))
    have = have.join(wanted.select(by, F.col(key).alias("__w")), by, "left")
    hit = F.coalesce(F.col(key) == F.col("__w"), F.lit(False))
    return have.groupBy(by).agg(F.min_by(key, F.struct(~hit, "__o", key)).alias(key), F.max(hit).alias("found"))


def state_text(values: dict[str, Column], defaults: dict[str, str]) -> Column:
    """A view's state as ``name=value&...``, names sorted; what equals its default, or is null, is left out."""
    parts = [F.when(text_of(c) != defaults.get(n, ""), F.concat(F.lit(f"{n}="), F.url_encode(c))) for n, c in sorted(values.items())]
    return F.concat_ws("&", *parts)


def state_fields(text: Column, defaults: dict[str, str], allowed: dict[str, list[str]] | None = None) -> Column:
    """A struct of the state's values, the default where a name is absent or its value isn't allowed; of a repeated name the first counts."""
    out = []
    for n, default in sorted(defaults.items()):
        raw = F.try_url_decode(F.regexp_extract(F.concat(F.lit("&"), text_of(text)), rf"&{n}=([^&]*)", 1))
        ok = raw != ""
        if allowed and n in allowed:
            ok = ok & raw.isin(allowed[n])
        out.append(F.when(ok, raw).otherwise(F.lit(default)).alias(n))
    return F.struct(*out)


def supporting_blocks(blocks: DataFrame, keywords: DataFrame, titles: DataFrame, most: int = 2) -> DataFrame:
    """(doc_id, rank, block_id, score): the blocks of each document that hold most of the keywords, ``most`` of them.

    ``blocks`` (doc_id, block_id, text), ``keywords`` (key), ``titles``
    (doc_id, title); keys, texts and titles are in match-key form already.  A
    block's score is its number of different keywords, one less where the
    document's title is among them; ties go by block_id.
    """
    long = blocks.filter(F.char_length("text") >= SHORT)
    # a list of keywords a block, not a row for each of them
    held = vocabulary.held_lists(long, ["doc_id", "block_id"], "text", keywords)
    held = held.join(titles.groupBy("doc_id").agg(F.collect_set("title").alias("titles")), "doc_id", "left")
    titled = F.coalesce(F.arrays_overlap("keys", "titles"), F.lit(False)).cast("long")
    blocks = held.groupBy("doc_id", "block_id").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"), F.max("titles").alias("titles"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), "block_id"))
    scored = blocks.select("doc_id", "block_id", (F.size("keys") - titled).alias("score")).withColumn("rank", rank)
    return scored.filter(F.col("rank") <= most).select("doc_id", "rank", "block_id", "score")


def backlog_order(priority: Column, status: Column, count: Column, key: Column) -> list[Column]:
    """Sort keys of a backlog: priority, status, most first, key."""
    place = F.lit(len(PRIORITIES))
    for name, i in PRIORITIES.items():
        place = F.when(priority == name, i).otherwise(place)
    return [place, status, -count, key]


def catalogue_grid(rows: DataFrame, seq: str, catalogue: list[str], name: str = "category") -> DataFrame:
    """``rows`` with each entry of a short fixed catalogue, numbered through: no join, as the catalogue is part of the plan.

    ``seq`` numbers the rows from 1 without gaps; ``number`` does so for the result.
    """
    out = rows.select("*", F.posexplode(F.array(*map(F.lit, catalogue))).alias("__p", name))
    return out.withColumn("number", (F.col(seq) - 1) * len(catalogue) + F.col("__p") + 1).drop("__p")


def chunk_bounds(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, n, least, most): a chunk's smallest and largest value, 0 where it has none."""
    zero = F.lit(0).cast(rows.schema[value].dataType)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.coalesce(F.min(value), zero).alias("least"), F.coalesce(F.max(value), zero).alias("most"))


def rebuilt_ledger(packets: list[DataFrame], drafts: DataFrame, key: str, fields: list[str], drafted: list[str]) -> DataFrame:
    """A ledger out of review packets: ``fields`` as the packets have them, ``drafted`` from the drafts of exceptions.

    Columns that a packet lacks, nulls, and drafted fields of a key without a
    draft are empty.  Of several drafts of a key the one with the largest
    ``seq``, then by its fields, counts.  Rows that packets repeat stay repeated.
    """
    blank = lambda df, c: (text_of(F.col(c).cast("string")) if c in df.columns else F.lit("")).alias(c)
    out = None
    for p in packets:
        rows = p.select(*(blank(p, c) for c in [key, *fields]))
        out = rows if out is None else out.unionByName(rows)
    last = drafts.groupBy(F.col(key).cast("string").alias(key)).agg(F.max(F.struct("seq", *(blank(drafts, c) for c in drafted))).alias("__d"))
    return out.join(last, key, "left").select(key, *fields, *(text_of(F.col("__d")[c]).alias(c) for c in drafted))
