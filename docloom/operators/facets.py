"""Read models over content rows: axis matrices, facets, roll-ups and networks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from docloom.operators.ranking import ranked

UNMAPPED = "unmapped"


def half_up_percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to the nearest whole number, halves up, in integer arithmetic; 0 where ``whole`` is 0."""
    return F.when(whole > 0, F.floor((200 * part + whole) / (2 * whole))).otherwise(0).cast("long")


def _distinct(rows: DataFrame, keys: list[Column], of: str, *carried: tuple[str, Callable[[str], Column]]) -> GroupedData:
    """A cell's different ``of``, grouped by the cell, with columns ``carried`` (name, how it is aggregated).

    One kind of value at a time, so that no row is laid out once for each kind
    that is counted.  Rows are dealt by cell and value first, over all shuffle
    partitions: values are mostly different, and a table of them in each
    earlier task, of which there may be few, would hold nearly all its rows.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*keys, F.col(of).alias("of"), *(F.col(c).alias(f"_{c}") for c, _ in carried)).repartition(partitions, "policy", "domain", "of")
    return dealt.groupBy("policy", "domain", "of").agg(*(how(f"_{c}").alias("e") for c, how in carried or [("", lambda _: F.lit(1))])).groupBy("policy", "domain")


def _same_cell(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two tables of cells side by side; a null policy is a cell too."""
    b = b.withColumnsRenamed({"policy": "__policy", "domain": "__domain"})
    return a.join(b, F.col("policy").eqNullSafe(F.col("__policy")) & (F.col("domain") == F.col("__domain"))).drop("__policy", "__domain")


def matrix(rows: DataFrame, policy: str, domain: str, group: str, content: str, evidence: str) -> DataFrame:
    """One row per (policy, domain): distinct groups, distinct contents, evidence and the intensity against the largest cell.

    ``rows`` has a row per content and term; a null term counts in the column
    ``unmapped``, so cells may add up to more than the contents.
    """
    keys = [F.col(policy).alias("policy"), F.coalesce(domain, F.lit(UNMAPPED)).alias("domain")]
    contents = _distinct(rows, keys, content, (evidence, F.sum)).agg(F.count("of").alias("n_contents"), F.coalesce(F.sum("e"), F.lit(0)).cast("long").alias("n_evidence"))
    groups = _distinct(rows, keys, group).agg(F.count("of").alias("n_groups"))
    cells = _same_cell(groups, contents).select("policy", "domain", "n_groups", "n_contents", "n_evidence")
    largest = F.greatest(F.max("n_contents").over(Window.partitionBy(F.lit(1))), F.lit(1))  # cells only: axis by axis
    return cells.withColumn("intensity", half_up_percent(F.col("n_contents"), largest))


def _named(facet: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value")))


def leave_one_out(rows: DataFrame, single: dict[str, str], many: dict[str, str], chosen: dict[str, str]) -> DataFrame:
    """(facet, value, n): a facet's counts use every chosen filter but its own.

    ``single`` maps facets to columns, ``many`` to array columns, whose row
    counts once for each of its terms.  One scan and one aggregation: each row
    is laid out once per facet that lets it through.
    """
    passes = {
        f: (F.array_contains(c, chosen[f]) if f in many else F.col(c) == chosen[f]) if f in chosen else F.lit(True)
        for f, c in {**single, **many}.items()
    }
    offers = []
    for f, c in {**single, **many}.items():
        values = F.array_distinct(F.col(c)) if f in many else F.array(F.col(c))
        others = F.lit(True)
        for g, ok in passes.items():
            if g != f:
                others = others & ok
        offers.append(F.when(others, _named(f, values)))
    offered = F.flatten(F.filter(F.array(*offers), lambda x: x.isNotNull()))
    return rows.select(F.explode(offered).alias("o")).select("o.*").filter("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))


def status_rollup(n: Column, reviewed: Column) -> Column:
    """empty, reviewed, needs_review or mixed."""
    return F.when(n == 0, "empty").when(reviewed == n, "reviewed").when(reviewed == 0, "needs_review").otherwise("mixed")


def edges(cells: DataFrame, scale: float = 1.5, least: float = 4.0, most: float = 40.0) -> DataFrame:
    """Network edges of the mapped cells, with the radius clamp(sqrt(weight) * scale)."""
    radius = F.least(F.greatest(F.sqrt("n_contents") * scale, F.lit(least)), F.lit(most))
    return cells.filter((F.col("domain") != UNMAPPED) & (F.col("n_contents") > 0)).select(
        "policy", "domain", F.col("n_contents").alias("weight"), F.round(radius, 4).alias("radius")
    )


def tone(ratio: Column) -> Column:
    """A briefing cell's tone by its ratio."""
    return F.when(ratio >= 1, "full").when(ratio >= 0.66, "strong").when(ratio >= 0.33, "some").otherwise("weak")


def options(dimension: DataFrame, counts: DataFrame, value: str, chosen: str | None) -> DataFrame:
    """(value, n, selected): all values of a dimension with their counts; those without rows only where they are chosen."""
    rows = dimension.join(counts, value, "left").select(value, F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce(F.col(value) == F.lit(chosen), F.lit(False)).alias("selected"))
    return rows.filter((F.col("n") > 0) | F.col("selected"))


def asset_insight(rows: DataFrame, asset: str, evidence: str, kind: str, preview: str) -> DataFrame:
    """(asset, n_evidence, kinds, priority): evidence inverted to assets; figures and images before PDFs before the rest."""
    priority = F.when(F.col(preview) == "figure", 3).when(F.col(preview) == "image", 2).when(F.col(preview) == "pdf", 1).otherwise(0)
    return rows.groupBy(asset).agg(F.count_distinct(evidence).alias("n_evidence"), F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"), F.max(priority).alias("priority"))


def first_seen_ids(rows: DataFrame, keys: list[str], seq: str, prefix: str, width: int) -> DataFrame:
    """(keys, id): distinct keys numbered over all in the order in which they were first seen.

    ``seq`` is numeric.  Keys are numbered in stretches, so that there may be as
    many as rows; a number of more than ``width`` digits keeps them all.
    """
    first = rows.groupBy(*keys).agg(F.min(seq).alias("__first"))
    placed = ranked(first, "__first", [F.col(c) for c in ("__first", *keys)], name="__id")
    return placed.select(*keys, F.format_string(f"{prefix}-%0{width}d", "__id").alias("id"))


def taxonomy_ids(rows: DataFrame) -> DataFrame:
    """(domain, subdomain, domain_id, subdomain_id) of rows (domain, subdomain, seq): TD-nnn and TSD-nnn-mmm as first seen."""
    pairs = rows.groupBy("domain", "subdomain").agg(F.min("seq").alias("s"))
    numbers = first_seen_ids(pairs, ["domain"], "s", "TD", 3).withColumnRenamed("id", "domain_id")
    place = F.row_number().over(Window.partitionBy("domain").orderBy("s", "subdomain"))
    out = pairs.withColumn("p", place).join(numbers, "domain")
    return out.select("domain", "subdomain", "domain_id", F.concat(F.lit("TSD-"), F.substring("domain_id", 4, 9), F.lit("-"), F.lpad(F.col("p").cast("string"), 3, "0")).alias("subdomain_id"))


def matrix_detail(rows: DataFrame, policy: str, domain: str, group: str, content: str, reviewed: str, strategy: str) -> DataFrame:
    """(policy, domain, n_groups, n_contents, n_reviewed, status, top_strategy): a cell's counts, its review and its most frequent strategy, the first by name among equals."""
    keys = [F.col(policy).alias("policy"), F.coalesce(domain, F.lit(UNMAPPED)).alias("domain")]
    contents = _distinct(rows, keys, content, (reviewed, F.bool_or)).agg(F.count("of").alias("n_contents"), F.count(F.when(F.col("e"), F.col("of"))).alias("n_reviewed"))
    cells = _same_cell(_distinct(rows, keys, group).agg(F.count("of").alias("n_groups")), contents)
    mix = rows.groupBy(*keys, F.col(strategy).alias("s")).agg(F.count("*").alias("n")).groupBy("policy", "domain").agg(F.min(F.struct((-F.col("n")).alias("n"), "s")).alias("m"))
    return cells.join(mix, ["policy", "domain"]).select("policy", "domain", "n_groups", "n_contents", "n_reviewed", status_rollup(F.col("n_contents"), F.col("n_reviewed")).alias("status"), F.col("m.s").alias("top_strategy"))


def nodes(cells: DataFrame, scale: float = 2.0, least: float = 6.0, most: float = 48.0) -> DataFrame:
    """(side, name, weight, radius): the policies and domains of a network by the weight of their mapped cells."""
    kept = cells.filter((F.col("domain") != UNMAPPED) & (F.col("n_contents") > 0))
    sides = [kept.groupBy(F.col(c).alias("name")).agg(F.sum("n_contents").alias("weight")).select(F.lit(c).alias("side"), "name", "weight") for c in ("policy", "domain")]
    radius = F.least(F.greatest(F.sqrt("weight") * scale, F.lit(least)), F.lit(most))
    return sides[0].unionByName(sides[1]).withColumn("radius", F.round(radius, 4))


def pivoted(cells: DataFrame, row: str, column: str, value: str, catalogue: list[str]) -> DataFrame:
    """(row, a column for each entry of the catalogue): the sums of ``value``, 0 where there is nothing.

    The catalogue fixes the columns and their order; an entry without cells
    stays, and what it doesn't list isn't shown.
    """
    return cells.groupBy(row).pivot(column, catalogue).agg(F.sum(value)).na.fill(0)


def collated(rows: DataFrame, group: str, label: str, locale: str = "ko") -> DataFrame:
    """(group, label, place): each group's different labels in a locale's order; what it holds for equal, in the order of code points."""
    labels = rows.select(group, label).filter(F.col(label).isNotNull()).distinct()
    order = Window.partitionBy(group).orderBy(F.collate(label, locale), F.col(label))
    return labels.withColumn("place", F.row_number().over(order))
