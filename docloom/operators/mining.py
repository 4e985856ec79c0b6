"""Candidate statements out of lines: tests, votes, deduplication, merge drafts and rule cascades.

Word lists are parameters: they belong to a language and a field.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators import folds, labels
from docloom.operators.fields import by_rules
from docloom.operators.textops import bound


@dataclass(frozen=True)
class Words:
    """What speaks for and against a statement."""

    strong: tuple[str, ...] = ()
    action: tuple[str, ...] = ()
    negative: tuple[str, ...] = ()
    context: tuple[str, ...] = ()
    structural: tuple[str, ...] = ()
    task_headings: tuple[str, ...] = ()
    cues: tuple[str, ...] = ()
    background: tuple[str, ...] = ()


#: Points of a strong word, parentheses, a year and great length; least points, under task headings; least characters.
STRONG, LABELLED, DATED, LONG, LEAST, LEAST_TASK, LEAST_CHARS, LONG_CHARS = 3, 2, 1, -1, 4, 2, 20, 180
YEAR = r"(?:19|20)\d{2}"


def hits(text: Column, words) -> Column:
    """How many of the words a text holds; empty words never count."""
    out = F.lit(0)
    for w in filter(None, words):
        out = out + F.contains(text, F.lit(w)).cast("int")
    return out


def _begins(text: Column, words) -> Column:
    out = F.lit(False)
    for w in filter(None, words):
        out = out | text.startswith(w)
    return out


def points(text: Column, words: Words, full: bool = True) -> Column:
    """A statement's points; not ``full``: without those for a year and for length, by which equal labels are told apart."""
    out = hits(text, words.strong) * STRONG + hits(text, words.action) + text.rlike(r"\([^()]+\)").cast("int") * LABELLED
    if full:
        out = out + text.rlike(YEAR).cast("int") * DATED + (F.char_length(text) > LONG_CHARS).cast("int") * LONG
    return out


def is_candidate(text: Column, heading: Column, words: Words) -> Column:
    """Whether a cleaned text states something: long enough, no scaffold or context, not negative without strong action, with enough points."""
    scaffold = text.isin(*words.structural) | (text.startswith("<") & text.endswith(">"))
    negative = (hits(text, words.negative) > 0) & (hits(text, words.strong) == 0)
    n = points(text, words)
    enough = (n >= LEAST) | ((n >= LEAST_TASK) & (hits(F.coalesce(heading, F.lit("")), words.task_headings) > 0))
    return (F.char_length(text) >= LEAST_CHARS) & ~scaffold & ~_begins(text, words.context) & ~negative & enough


def mined(lines: DataFrame, words: Words, category: Column, heading: str = "heading", id_col: str = "doc_id") -> DataFrame:
    """(id, pos, category, label, summary, points, seq): candidates, of equal category and label that with the most points, the first among equals.

    ``seq`` numbers what is kept by id and place within its category.
    """
    # a cleaned line is made once: in a filter it would be put into each of the conditions
    cleaned = lines.select(id_col, "pos", F.col(heading).alias("__h"), category.alias("category"), F.explode(F.array(labels.collapsed(F.col("line")))).alias("__t"))
    rows = cleaned.filter(is_candidate(F.col("__t"), F.col("__h"), words))
    rows = rows.select(id_col, "pos", "category", labels.label(F.col("__t")).alias("label"), labels.summary(F.col("__t")).alias("summary"), points(F.col("__t"), words, full=False).alias("points"))
    best = F.min_by(F.struct(id_col, "pos", "summary", "points"), F.struct(-F.col("points"), F.col(id_col), F.col("pos")))
    kept = rows.groupBy("category", "label").agg(best.alias("b")).select("category", "label", "b.*")
    return kept.select(id_col, "pos", "category", "label", "summary", "points")


def emitted(kept: DataFrame, id_col: str = "doc_id") -> dict[str, DataFrame]:
    """Item, display, link and map rows of mined statements; one key ties them together."""
    key = F.concat(F.lit("PIT-"), F.col(id_col).cast("string"), F.lit("-"), F.lpad(F.col("pos").cast("string"), 5, "0"))
    rows = kept.withColumn("item_id", key)
    return {
        "items": rows.select("item_id", F.col("label").alias("item_label"), "category"),
        "displays": rows.select(F.concat(F.lit("DSP-"), "item_id").alias("display_id"), "item_id", F.col("label").alias("title_text"), F.col("summary").alias("summary_text")),
        "links": rows.select("item_id", id_col, "pos", F.lit(True).alias("is_primary")),
        "maps": rows.select("item_id", "category", F.lit("auto_mapped").alias("review_status")),
    }


# the merge draft


def skip_reason(text: Column, block_type: Column, has_taxonomy: Column, words: Words) -> Column:
    """Why a row can't open a group: the first reason that holds; null: it can."""

    def reason(text: Column, acts: Column) -> Column:
        n = F.char_length(text)
        tail = F.right(text, F.lit(50))
        signs = (F.regexp_count(text, F.lit("[․]")) >= 4) | (F.regexp_count(text, F.lit(r"\[")) >= 3) | (F.regexp_count(text, F.lit("→")) >= 2)
        para = block_type == "paragraph"
        return by_rules(
            [
                (_begins(text, words.structural), "section_scaffold"),
                (text.rlike(r"^\(?\d+\)?\s*(?:items?|개)"), "group_count_scaffold"),
                (text.rlike(r"^(?:\*|e\.g\.|예\))"), "example_scaffold"),
                (_begins(text, words.context) & ~acts, "context_scaffold"),
                ((hits(tail, words.background) > 0) & (hits(text, words.cues) == 0), "background_tail"),
                ((hits(text, words.negative) > 0) & ~acts, "background_statement"),
                (para & (n <= 40) & ~acts, "short_paragraph_scaffold"),
                (para & signs & ~acts, "diagram_or_schedule_paragraph"),
                (para & (n >= 150) & ~acts, "long_background_paragraph"),
                (~acts & ~has_taxonomy & (n <= 80), "no_action_no_taxonomy"),
            ],
            None,
        )

    # the text and whether it acts are made once, not in each rule
    return bound(text, lambda t: bound(hits(t, words.strong + words.action) > 0, lambda acts: reason(t, acts)))


#: Block types that attach to a group for review; the longest paragraph that continues one whatever it begins with.
ATTACHED, CONTINUES = ("note", "citation", "caption"), 80


#: Parts of a draft group; the number of a row's part is its place here.
PARTS = ("", "primary", "continuation", "review")


def _grouped(state: tuple | None, row: tuple) -> tuple[tuple, int]:
    """One row (page, kind, attached, goes_on) of the pass; kind 0: review, 1: closed, 2: opens or continues.

    The state is (group or None, its page, the last page, groups made); the
    number given is the group times four and the part's place in ``PARTS``.
    """
    page, kind, attached, goes_on = row
    group, of, last, made = state or (None, None, None, 0)
    part = 0
    if kind == 0:
        if group is not None and page == of and attached:
            part = 3
    elif kind == 1:
        if group is not None and page != of:
            group = None
    elif group is not None and page == of == last and goes_on:
        part = 2
    else:
        made += 1
        group, of, part = made, page, 1
    return (group, of, page, made), (group * 4 + part if part else 0)


def grouped_rows(rows: list[dict]) -> list[tuple[int | None, str]]:
    """For ordered rows (page, candidate, skip, block_type, chars, marked) the group of each and its part: primary, continuation, review or none.

    A group closes where another page turns up in a row that isn't merely
    under review, and where a new primary row opens the next.
    """
    kind = lambda r: 0 if r["candidate"] == "review" else 1 if r["candidate"] != "yes" or r["skip"] else 2
    goes_on = lambda r: r["block_type"] == "paragraph" and (r["chars"] <= CONTINUES or not r["marked"])
    found = folds.fold(_grouped, [(r["page"], kind(r), r["block_type"] in ATTACHED, goes_on(r)) for r in rows])
    return [(n // 4 or None, PARTS[n % 4]) for n in found]


def merge_draft(rows: DataFrame, id_col: str = "doc_id", order: str = "pos") -> DataFrame:
    """(id, group_no, page, text, n_continuations, n_reviews, confidence): each document's rows merged into draft groups.

    ``rows`` has id, order, page, candidate, skip, block_type, text.  Rows meet
    once, as an array a document, along which the groups are told in one pass.
    """
    candidate, block_type = F.coalesce("candidate", F.lit("")), F.coalesce("block_type", F.lit(""))
    kind = F.when(candidate == "review", 0).when((candidate != "yes") | (F.coalesce("skip", F.lit("")) != ""), 1).otherwise(2)
    goes_on = (block_type == "paragraph") & (F.coalesce(F.char_length("text") <= CONTINUES, F.lit(False)) | ~F.coalesce(F.col("text").rlike("^[-*•□ㅇ○]"), F.lit(False)))
    row = F.struct(order, "page", kind.alias("kind"), block_type.isin(*ATTACHED).cast("int").alias("attached"), goes_on.cast("int").alias("goes_on"), (block_type == "bullet").alias("bullet"), "text")
    by = rows.groupBy(id_col).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    found = folds.scanned(by, "rows", ["page", "kind", "attached", "goes_on"], _grouped, "found")
    kept = F.filter(F.arrays_zip("rows", "found"), lambda x: x["found"] > 0)
    whole = found.select(id_col, F.explode(kept).alias("x")).select(id_col, F.expr("x.found div 4").alias("group_no"), (F.col("x.found") % 4).alias("part"), "x.rows.*")
    is_part = lambda name: F.col("part") == PARTS.index(name)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~is_part("review"), F.struct(order, "text")))), lambda x: x["text"]), " ")
    n = lambda name: F.count_if(is_part(name))
    confidence = F.when((n("continuation") > 0) | (n("review") > 0) | F.bool_or(is_part("primary") & F.col("bullet")), "medium").otherwise("low")
    return whole.groupBy(id_col, "group_no").agg(F.min(F.when(is_part("primary"), F.col("page"))).alias("page"), text.alias("text"), n("continuation").alias("n_continuations"), n("review").alias("n_reviews"), confidence.alias("confidence"))


def rolled_up(df: DataFrame, by: list[str], order: str, columns: list[str], text: str | None = None) -> DataFrame:
    """Per group the distinct values of array columns in order of appearance, and the texts joined."""
    out = []
    for c in columns:
        rows = F.array_sort(F.collect_list(F.struct(order, c)))
        out.append(F.array_distinct(F.flatten(F.filter(rows[c], lambda x: x.isNotNull()))).alias(c))
    if text:
        rows = F.array_sort(F.collect_list(F.struct(order, text)))
        out.append(F.array_join(F.transform(rows, lambda x: x[text]), " ").alias(text))
    return df.groupBy(*by).agg(*out)


# roles


@dataclass(frozen=True)
class RoleWords:
    """What tells the role of a statement; word lists, and patterns where named so."""

    change: tuple[str, ...] = ()
    change_acts: tuple[str, ...] = ()
    frame: tuple[str, ...] = ()
    short_frame: tuple[str, ...] = ()
    case_pattern: str = r"(?!)"
    direction: str = "☞"
    background: tuple[str, ...] = ()
    hard_problem: tuple[str, ...] = ()
    soft_problem: tuple[str, ...] = ()
    need_pattern: str = r"(?!)"
    strong: tuple[str, ...] = ()
    acts: tuple[str, ...] = ()


#: Fixed value: the longest text that a word of ``short_frame`` alone makes a frame.
SHORT_FRAME = 30


def statement_role(text: Column, words: RoleWords) -> Column:
    """A struct (role, note) of a statement, by the first rule that holds; a null text is an action without a note.

    A softer sign of a problem, or of a need, makes one only where nothing in
    the text acts.
    """
    has = lambda of: (hits(text, of) > 0) if of else F.lit(False)
    acts = has(words.acts) | has(words.strong)
    rules = [
        (has(words.change) & has(words.change_acts), "regulatory_delta", "detected_current_to_improvement_pattern"),
        (has(words.frame), "meta_program_frame", "detected_program_frame_keyword"),
        ((F.char_length(text) <= SHORT_FRAME) & has(words.short_frame), "meta_program_frame", "detected_short_meta_bullet"),
        (text.rlike(words.case_pattern) & text.rlike('[“"]'), "case_example", "detected_case_example_quote"),
        (text.startswith(words.direction), "policy_action", "detected_improvement_direction_prefix"),
        (has(words.background) & ~has(words.strong), "background_context", "detected_background_keyword"),
        (has(words.hard_problem), "problem_or_requirement", "detected_problem_keyword"),
        (has(words.soft_problem) & acts, "policy_action", "detected_soft_problem_but_action_overrides"),
        (has(words.soft_problem), "problem_or_requirement", "detected_problem_keyword"),
        (text.rlike(words.need_pattern) & acts, "policy_action", "detected_need_phrase_but_action_overrides"),
        (text.rlike(words.need_pattern), "problem_or_requirement", "detected_need_phrase"),
    ]
    made = lambda role, note: F.struct(F.lit(role).alias("role"), F.lit(note).alias("note"))
    out = made("policy_action", "")
    for holds, role, note in reversed(rules):
        out = F.when(F.coalesce(holds, F.lit(False)), made(role, note)).otherwise(out)
    return out


# rule cascades


@dataclass(frozen=True)
class Rule:
    """If a text holds any of ``any_of``, all of ``all_of`` and none of ``none_of``, it gives the values."""

    values: tuple[str, ...]
    any_of: tuple[str, ...] = field(default=())
    all_of: tuple[str, ...] = field(default=())
    none_of: tuple[str, ...] = field(default=())

    def holds(self, text: Column) -> Column:
        out = (hits(text, self.any_of) > 0) if self.any_of else F.lit(True)
        if self.all_of:
            out = out & (hits(text, self.all_of) == len(self.all_of))
        if self.none_of:
            out = out & (hits(text, self.none_of) == 0)
        return out


def cascade(text: Column, rules: list[Rule], names: list[str], default: tuple[str, ...]) -> Column:
    """A struct of the first rule's values; rules are data."""

    def made(values: tuple[str, ...]) -> Column:
        return F.struct(*(F.lit(v).cast("string").alias(n) for v, n in zip(values, names, strict=True)))

    out = made(default)
    for r in reversed(rules):
        out = F.when(F.coalesce(r.holds(text), F.lit(False)), made(r.values)).otherwise(out)
    return out


def numbered(df: DataFrame, by: str, order: list[Column], name: str = "display_order") -> DataFrame:
    """A running number within each ``by``."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order)))
