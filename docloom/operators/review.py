"""The keyed review ledger: keys, queues, reconciliation and application of decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def decision_key(prefix: str, policy: Column, *parts: Column) -> Column:
    """A stable key: prefix, policy and twelve hex digits of SHA-1 over all parts; a missing part counts as empty."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in (policy, *parts)))
    return F.concat(F.lit(f"{prefix}-"), F.coalesce(policy.cast("string"), F.lit("")), F.lit("-"), F.substring(F.sha1(joined), 1, 12))


def reconcile(queue: DataFrame, ledger: DataFrame, key: str, seed: Column, resolved: Column) -> DataFrame:
    """One ledger out of the queue and the old one.

    Machine fields come from the queue, a decision from the ledger.  New keys
    are pending, or auto-seeded where ``seed`` holds; resolved keys that left
    the queue stay as inactive, pending ones go.
    """
    q = queue.withColumn("__q", F.lit(True))
    old = ledger.withColumn("__l", F.lit(True))
    both = q.join(old, key, "full_outer")
    in_q, in_l = F.col("__q").isNotNull(), F.col("__l").isNotNull()
    return (
        both.filter(in_q | resolved)
        .withColumn("active", in_q)
        .withColumn("status", F.when(in_l & resolved, F.col("status")).when(seed, "auto_seeded").otherwise("pending"))
        .drop("__q", "__l")
    )


def first_wins(edits: DataFrame, key: list[str], order: str) -> DataFrame:
    """The first edit of each key and how many later ones it beat."""
    return edits.groupBy(*key).agg(F.min(order).alias(order), (F.count("*") - 1).alias("n_beaten"))


def upsert(base: DataFrame, incoming: DataFrame, key: str, seq: str | None = None) -> DataFrame:
    """Rows of ``incoming`` replace those of the same key; of several of one key the last by ``seq``, without it the largest by its columns in order."""
    others = [c for c in incoming.columns if c != key]
    by = [seq, *(c for c in others if c != seq)] if seq else others
    last = incoming.groupBy(key).agg(F.max(F.struct(*by)).alias("__last"))
    fresh = last.select(key, *(F.col(f"__last.{c}") for c in others if c != seq))
    return base.join(fresh.select(key), key, "left_anti").unionByName(fresh.select(*base.columns))


def guarded_delete(rows: DataFrame, key: str, doomed: Column, protected: DataFrame) -> DataFrame:
    """``rows`` without the doomed ones, unless their key is protected."""
    guard = protected.select(F.col(key)).distinct().withColumn("__guard", F.lit(True))
    return rows.join(guard, key, "left").filter(~F.coalesce(doomed, F.lit(False)) | F.col("__guard").isNotNull()).drop("__guard")


def lens_key(domain: Column, policy: Column, category: Column, item_ids: Column) -> Column:
    """A stable key of a domain, policy, category and a set of items, in whatever order and however often they are listed."""
    ids = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(item_ids, F.lit("")), "[|,]"), lambda x: F.trim(x)), lambda x: x != "")))
    parts = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in (domain, policy, category)), F.array_join(ids, " | "))
    return F.concat(F.lit("TLR-"), F.coalesce(domain.cast("string"), F.lit("")), F.lit("-"), F.substring(F.sha1(parts), 1, 12))


def applied(decisions: DataFrame, items: DataFrame, key: str, item: str, choices: list[str], none: str = "no_strategy") -> dict[str, DataFrame]:
    """Decisions (key, active, choice, terms) resolved to items: their outcome, and the mapping and assertion rows that they give.

    Outcomes: invalid_decision (a choice that doesn't exist, or no term for a
    choice that needs one), missing_target and inactive_missing_target (no item
    has the key), applied.  Of an applied decision the first term is primary.
    """
    known = items.select(key, item).dropDuplicates([key])
    rows = decisions.join(known, key, "left")
    empty = F.coalesce(F.size("terms"), F.lit(0)) <= 0
    bad = ~F.coalesce(F.col("choice").isin(*choices, none), F.lit(False)) | ((F.col("choice") != none) & empty)
    missing = F.when(F.col("active"), "missing_target").otherwise("inactive_missing_target")
    rows = rows.withColumn("outcome", F.when(bad, "invalid_decision").when(F.col(item).isNull(), missing).otherwise("applied"))
    done = rows.filter("outcome = 'applied'")
    mapped = done.filter(F.col("choice") != none).select(item, F.posexplode("terms").alias("p", "term"))
    return {
        "outcomes": rows.select(key, "outcome"),
        "mappings": mapped.select(item, "term", (F.col("p") == 0).alias("is_primary"), F.lit("reviewed").alias("review_status")),
        "assertions": done.select(item, F.when(F.col("choice") == none, "NO_STRATEGY").otherwise("REVIEWED").alias("assertion")),
    }


def merged_batches(ledger: DataFrame, edits: DataFrame, key: str, order: list[str], fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """The ledger with the first edit of each key, and a report (key, problem) of duplicate edits and of keys that the ledger lacks."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    numbered = edits.withColumn("__place", place)
    first = numbered.filter("__place = 1").select(key, *(F.col(f).alias(f"__{f}") for f in fields))
    out = ledger.join(first.withColumn("__there", F.lit(True)), key, "left")
    for f in fields:
        out = out.withColumn(f, F.when(F.col("__there"), F.col(f"__{f}")).otherwise(F.col(f)))
    twice = numbered.filter("__place > 1").select(key, F.lit("duplicate").alias("problem"))
    missing = first.join(ledger.select(key), key, "left_anti").select(key, F.lit("missing").alias("problem"))
    return out.select(*ledger.columns), twice.unionByName(missing)


def finalised(ledger: DataFrame, decided: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The ledger with constant decisions put in: ``change`` is changed, same, appended or untouched; keys compare null-safely."""
    fresh = decided.select(key, *(F.col(f).alias(f"__{f}") for f in fields)).withColumn("__d", F.lit(True))
    both = ledger.withColumn("__l", F.lit(True)).join(fresh, key, "full_outer")
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"__{f}"))
    change = F.when(F.col("__d").isNull(), "untouched").when(F.col("__l").isNull(), "appended").when(same, "same").otherwise("changed")
    both = both.withColumn("change", change)
    for f in fields:
        both = both.withColumn(f, F.when(F.col("__d"), F.col(f"__{f}")).otherwise(F.col(f)))
    return both.select(*ledger.columns, "change")


def missing_keys(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return required.select(key).distinct().join(present.select(key), key, "left_anti")


def lens_synced(queue: DataFrame, ledger: DataFrame, key: str, preserved: Column, *editable: str) -> DataFrame:
    """``reconcile`` for lens rows: those that left the queue stay where their status is preserved or a person edited a field."""
    edited = preserved
    for f in editable:
        edited = edited | (F.trim(F.coalesce(F.col(f), F.lit(""))) != "")
    return reconcile(queue, ledger, key, F.lit(False), F.coalesce(edited, F.lit(False)))


def packet_index(rows: DataFrame, by: str, status: str, values: list[str]) -> DataFrame:
    """(by, n, n_<status>...): the index of packets, statuses side by side."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), *(F.count_if(F.col(status) == v).alias(f"n_{v.lower()}") for v in values))


def rejection_report(rows: DataFrame, domain: str, status: str, reason: str) -> DataFrame:
    """(domain, n_rejected, reasons): rejected rows by domain with their distinct reasons."""
    return rows.filter(F.col(status) == "rejected").groupBy(domain).agg(F.count("*").alias("n_rejected"), F.array_join(F.array_sort(F.collect_set(reason)), " | ").alias("reasons"))


def overlaid(rows: DataFrame, decisions: DataFrame, key: str, fields: list[str], fallback: str | None = None, seq: str | None = None) -> DataFrame:
    """``rows`` with decided fields, found by ``key``, else by ``fallback``; of several decisions of a key the last by ``seq``, then by all fields, counts, without it the largest by all fields."""
    for by in [key] if fallback is None else [key, fallback]:
        one = decisions.groupBy(F.col(key).alias(by)).agg((F.max(F.struct(*fields)) if seq is None else F.max_by(F.struct(*fields), F.struct(seq, *fields))).alias(f"__{by}"))
        rows = rows.join(one, by, "left")
    found = [f"__{key}"] if fallback is None else [f"__{key}", f"__{fallback}"]
    for f in fields:
        rows = rows.withColumn(f, F.coalesce(*(F.col(x)[f] for x in found), F.col(f)))
    return rows.drop(*found)


def merged_items(rows: DataFrame, item: str = "item", into: str = "into", evidence: str = "evidence") -> tuple[DataFrame, DataFrame]:
    """Leaders with the ordered evidence of themselves and their followers, and an issue log.

    ``rows`` (item, into, evidence, decision): a row with ``into`` follows that
    item, one level deep; a row whose decision is ``drop`` goes.  Issues:
    missing_leader, dropped_leader, nested_merge, no_evidence.
    """
    kept = rows.filter(~F.coalesce(F.col("decision") == "drop", F.lit(False)))
    leads = kept.filter(F.col(into).isNull()).select(F.col(item).alias("leader"), F.col(evidence).alias("own"))
    follows = kept.filter(F.col(into).isNotNull()).select(item, F.col(into).alias("leader"), evidence)
    more = follows.groupBy("leader").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(item, evidence))), lambda x: x[evidence])).alias("more"))
    none = F.expr("cast(array() as array<string>)")
    out = leads.join(more, "leader", "left").select("leader", F.array_distinct(F.concat(F.coalesce("own", none), F.coalesce("more", none))).alias(evidence))
    every = rows.select(F.col(item).alias("leader"), F.col(into).alias("next"), (F.coalesce(F.col("decision"), F.lit("")) == "drop").alias("gone"))
    lost = follows.join(every, "leader", "left")
    issue = F.when(F.col("gone").isNull(), "missing_leader").when(F.col("gone"), "dropped_leader").when(F.col("next").isNotNull(), "nested_merge")
    issues = lost.select(F.col(item).alias("item"), issue.alias("issue")).filter("issue is not null")
    return out, issues.unionByName(out.filter(F.size(evidence) == 0).select(F.col("leader").alias("item"), F.lit("no_evidence").alias("issue")))


def workbench_priority(role: Column, n_evidence: Column, confidence: Column) -> Column:
    """high, medium or low: what acts and is well founded comes first."""
    acts = role.isin("policy_action", "regulatory_delta")
    return F.when(acts & (n_evidence > 0) & (confidence != "low"), "high").when(acts | (n_evidence > 0), "medium").otherwise("low")


def suggested_action(role: Column) -> Column:
    return F.when(role.isin("policy_action", "regulatory_delta"), "keep").when(role == "case_example", "attach").when(role.isin("background_context", "problem_or_requirement"), "demote").otherwise("review")


def reviewed_rows(rows: DataFrame, reviewed: DataFrame, key: str, signature: list[str], fields: list[str]) -> DataFrame:
    """``rows`` with ``match``: applied, skipped (nothing decided), mismatched (the content has changed since) or missing; applied ones have the fields."""
    sign = F.sha2(F.concat_ws("\u0001", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in signature)), 256)
    have = rows.withColumn("__sign", sign).withColumn("__row", F.lit(True))
    given = reviewed.select(key, F.col("signature"), *(F.col(f).alias(f"__{f}") for f in fields)).withColumn("__given", F.lit(True))
    both = have.join(given, key, "full_outer")
    blank = F.lit(True)
    for f in fields:
        blank = blank & (F.trim(F.coalesce(F.col(f"__{f}"), F.lit(""))) == "")
    match = F.when(F.col("__row").isNull(), "missing").when(F.col("__given").isNull() | blank, "skipped").when(F.col("signature") != F.col("__sign"), "mismatched").otherwise("applied")
    both = both.withColumn("match", match)
    for f in fields:
        both = both.withColumn(f, F.when(F.col("match") == "applied", F.col(f"__{f}")).otherwise(F.col(f)))
    return both.select(*rows.columns, "match")


def exception_ids(explicit: Column, notes: Column, known: list[str]) -> Column:
    """The listed ids, else the known ones that the notes name."""
    listed = F.filter(F.transform(F.split(F.coalesce(explicit, F.lit("")), "[|,]"), lambda x: F.trim(x)), lambda x: x != "")
    named = F.filter(F.array(*map(F.lit, known)), lambda k: F.contains(F.coalesce(notes, F.lit("")), k))
    return F.when(F.size(listed) > 0, listed).otherwise(named)
