"""The projection of items to domains: one primary domain each, provisional fill, roll-ups and curation stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators.fields import by_rules, text_of

#: Order of resource categories; groups from which a domain counts as covered.
CATEGORY_ORDER, SEED, COVERED = {"technology": 0, "infrastructure_institutional": 1, "talent": 2}, 3, 6


def primary_terms(terms: DataFrame, item: str, term: str, is_primary: str) -> DataFrame:
    """(item, n_primary, term): each item's primary term; null unless it has exactly one."""
    main = F.col(is_primary).cast("boolean")
    by = terms.groupBy(item).agg(F.count_if(main).alias("n_primary"), F.min(F.when(main, F.col(term))).alias("__t"))
    return by.select(item, "n_primary", F.when(F.col("n_primary") == 1, F.col("__t")).alias(term))


def assigned(items: DataFrame, terms: DataFrame, item: str, term: str, is_primary: str = "is_primary") -> DataFrame:
    """``items`` with their domain and an assignment: assigned, ambiguous (several primary ones) or unassigned."""
    one = primary_terms(terms, item, term, is_primary)
    n = F.coalesce("n_primary", F.lit(0))
    return items.join(one, item, "left").withColumn("assignment", F.when(n == 1, "assigned").when(n > 1, "ambiguous").otherwise("unassigned")).drop("n_primary")


def split_taxonomy(terms: Column) -> Column:
    """A struct (primary, secondary, strategies) of an array of (term_type, term_id, is_primary)."""
    ids = lambda keep: F.transform(F.filter(terms, keep), lambda t: t["term_id"])
    domain = lambda t: t["term_type"] == "tech_domain"
    return F.struct(
        F.get(ids(lambda t: domain(t) & t["is_primary"]), F.lit(0)).alias("primary"),
        ids(lambda t: domain(t) & ~t["is_primary"]).alias("secondary"),
        ids(lambda t: t["term_type"] == "strategy").alias("strategies"),
    )


def provisional_key(reviewed: Column, primary: Column, category: Column, policy_order: Column, priority: Column, item: Column) -> Column:
    """A sort key: a reviewed primary strategy before any before none, then category, policy, priority descending, id."""
    strength = F.when(reviewed, 0).when(primary, 1).otherwise(2)
    place = F.lit(9)
    for c, i in CATEGORY_ORDER.items():
        place = F.when(category == c, i).otherwise(place)
    return F.struct(strength.alias("strength"), place.alias("category"), policy_order.alias("policy"), (-priority).alias("priority"), item.alias("item"))


def provisional_fill(candidates: DataFrame, existing: DataFrame, domain: str, pair: list[str], key: Column, most: int) -> DataFrame:
    """Candidates that fill a domain's free places, of each pair the first before any second one; ``display_order`` goes on from the existing groups.

    ``existing`` (domain, n_groups, n_auto, last_order): a domain with groups
    of which none is automatic is complete; one with automatic groups gets what
    is left of ``most``; an empty one gets ``most``.
    """
    rows = candidates.withColumn("__key", key)
    later = F.row_number().over(Window.partitionBy(domain, *pair).orderBy("__key")) > 1
    place = F.row_number().over(Window.partitionBy(domain).orderBy("__later", "__key"))
    rows = rows.withColumn("__later", later).withColumn("__place", place).join(existing, domain, "left")
    n, auto = F.coalesce("n_groups", F.lit(0)), F.coalesce("n_auto", F.lit(0))
    slots = F.when(n == 0, most).when(auto > 0, F.greatest(most - n, F.lit(0))).otherwise(0)
    out = rows.filter(F.col("__place") <= slots).withColumn("display_order", (F.coalesce("last_order", F.lit(0)) + F.col("__place")).cast("long"))
    return out.select(*candidates.columns, "display_order")


def provisional_groups(filled: DataFrame, item: str, title: Column, summary: Column, statement: Column) -> DataFrame:
    """(group_id, content_id, group_label, group_summary, status, display_order, item): a group with one content for each item."""
    short = F.coalesce(F.nullif(text_of(summary), F.lit("")), statement)
    key = F.col(item).cast("string")
    return filled.select(
        F.concat(F.lit("PIG-PROV-"), key).alias("group_id"), F.concat(F.lit("PIC-PROV-"), key).alias("content_id"), title.alias("group_label"), short.alias("group_summary"), F.lit("provisional_auto").alias("status"), "display_order", item
    )


def domain_rollup(rows: DataFrame, domain: str, group: str, content: str, policy: str, category: str, strategy: str, order: str) -> DataFrame:
    """(domain, n_groups, n_contents, n_policies, categories, strategies): counts, counts by category, and each strategy's last label.

    ``categories`` and ``strategies`` are maps with a few entries a domain.
    """
    by = rows.groupBy(domain).agg(F.count_distinct(group).alias("n_groups"), F.count_distinct(content).alias("n_contents"), F.count_distinct(policy).alias("n_policies"))
    kinds = rows.groupBy(domain, category).agg(F.count_distinct(group).alias("n")).groupBy(domain).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(category, "n")))).alias("categories"))
    last = rows.groupBy(domain, strategy).agg(F.max_by(group, order).alias("g")).groupBy(domain).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(strategy, "g")))).alias("strategies"))
    return by.join(kinds, domain, "left").join(last, domain, "left")


def curation_stage(n_groups: Column, n_curated: Column) -> Column:
    """empty, seed (nothing curated), expand (too little curated) or covered."""
    return by_rules([(n_groups == 0, "empty"), (n_curated == 0, "seed"), (n_curated < COVERED, "expand")], "covered")


def draft_pack(groups: DataFrame, group: str, items: str, contents: str) -> dict[str, DataFrame]:
    """Row sets of nested groups (arrays of item ids and of content texts): groups, members, contents, links, displays, assertions."""
    head = groups.select(group, items, contents)
    content_id = F.format_string("%s-C%02d", F.col(group).cast("string"), F.col("p") + 1)
    exploded = head.select(group, F.posexplode(contents).alias("p", "text"))
    members = head.select(group, F.posexplode(items).alias("p", "item"))
    return {
        "groups": head.select(group, F.size(items).cast("long").alias("n_items"), F.size(contents).cast("long").alias("n_contents")),
        "members": members.select(group, "item", (F.col("p") == 0).alias("is_representative")),
        "contents": exploded.select(content_id.alias("content_id"), group, (F.col("p") + 1).cast("long").alias("display_order"), "text"),
        # an item for each content, in the group's own row: no join
        "links": head.filter(F.col(group).isNotNull()).select(group, items, F.posexplode(contents).alias("p", "text")).select(group, content_id.alias("content_id"), F.explode(items).alias("item")),
        "displays": head.select(group, F.get(contents, F.lit(0)).alias("title_text")),
        "assertions": head.select(group, F.lit("seed_draft").alias("status")),
    }


def regrouped(rows: DataFrame, policy: str, domain: str, group: str, order: str) -> DataFrame:
    """(policy, groups): domain-rooted groups put below their policy, each once, where it was seen first."""
    first = rows.groupBy(policy, group).agg(F.min(F.struct(order, domain)).alias("at"))
    return first.groupBy(policy).agg(F.array_sort(F.collect_list(F.struct(F.col(f"at.{order}").alias("seq"), F.col(group).alias("group"), F.col(f"at.{domain}").alias("domain")))).alias("groups"))


def polymorphic(links: DataFrame, dimensions: dict[str, DataFrame], kind: str = "kind", key: str = "key") -> DataFrame:
    """Links with the ``label`` of what they name, each in the dimension of its kind: one left join to the union of the dimensions.

    A dimension has ``key`` and ``label``; a kind or key that isn't there gives null.
    """
    every = reduce(DataFrame.unionByName, (d.select(F.lit(name).alias(kind), F.col(key).cast("string").alias("__key"), "label") for name, d in dimensions.items()))
    return links.withColumn("__key", F.col(key).cast("string")).join(every, [kind, "__key"], "left").drop("__key")


def drill_down(top: DataFrame, steps: list[tuple[DataFrame, list[tuple[str, str]]]]) -> DataFrame:
    """``top`` with each step left-joined on pairs of columns, the fan-out kept: one row for each path, also for one that ends early."""
    out = top
    for rows, on in steps:
        out = out.join(rows, reduce(lambda a, b: a & b, (F.col(x) == F.col(y) for x, y in on)), "left")
    return out
