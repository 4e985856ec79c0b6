"""Sections of structured text: lines to units, and a section's blocks cleaned in a row of passes.

A section is an array of blocks in its row.  Every pass is an expression over
the array bound once, so its time is linear; passes that look ahead pair each
block with the next one.  A block is a struct of block_type, text, lines (of
the source), merged (blocks) and actions (what was done to it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.operators.textops import bound, runs

# Marks of bullets, items and headings, and forms of labels.
BULLET = r"^(?:[-*]+|[ㅇ□▪•⦁◦➊➋➌➍➎➏➐➑➒➓☞⇒⇨])\s*"
ITEM = r"^[①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳]\s*\S"
OPENS_UNIT = rf"{BULLET}|^\*{{1,2}}\s*\S|^※|{ITEM}|^[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+(?:[.)]\s*|\s+)|^\d+[.)]\s*\S"
CITATION = r"^\(.*[’']?\d{2}.*\)$"
NUMERAL = r"^(?:I|II|III|IV|V|VI|VII|VIII|IX|X)$"
SPACED_LABEL = r"^[가-힣](?:\s+[가-힣]){1,5}$"
CONTACT = r"(?i)^(?:전\s*화|E-?mail)\s*:"
#: Fixed values, in characters: a title after a numeral; a small block and the blocks of a cover; a heading to be; captions; a contact's lines; fragments.
TITLE, SMALL, COVER_BLOCKS, HEADING, BARE_HEADING, CAPTION, CONTACT_LINE, FRAGMENT, CELL = 24, 18, 12, 20, 6, 32, 50, 12, 10


@dataclass(frozen=True)
class Words:
    """Patterns of the corpus: main headings, and blocks that are a label by themselves."""

    main_heading: str = r"(?:의결주문|제안이유|주요 내용|추진 배경|추진 과제|향후 조치 계획)"
    label: str = r"^(?:내용|예산|유형|인재|인프라|전략|제도|참고|금융|분야\s*\d+)$"


def _block(b: Column, action: str | None = None, **changed: Column) -> Column:
    done = b["actions"] if action is None else F.concat(b["actions"], F.array(F.lit(action)))
    return F.struct(*(changed.get(n, b[n]).alias(n) for n in ("block_type", "text", "lines", "merged")), done.alias("actions"))


def structured_units(lines: Column) -> Column:
    """Structs (text, lines) of a block's lines: one begins at each bullet, note, item or heading, and at a citation unless the unit is a note.

    Whether a citation opens a unit depends on how the unit began, so lines are
    first cut at marks, and each piece that doesn't begin with a note once more
    at its citations.
    """
    clean = F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")
    pieces = runs(clean, lambda x, _: x.rlike(OPENS_UNIT))
    is_note = lambda x: x.rlike(r"^(?:※|\*{1,2}\s*\S)")
    cut = lambda r: F.when(is_note(r[0]), F.array(r)).otherwise(runs(r, lambda x, _: x.rlike(CITATION)))
    return bound(F.flatten(F.transform(pieces, cut)), lambda us: F.transform(us, lambda u: F.struct(F.array_join(u, " ").alias("text"), F.size(u).cast("long").alias("lines"))))


def pairs_joined(blocks: Column, joins, joined) -> Column:
    """Blocks with each one for which ``joins(block, next)`` holds made one with the next by ``joined(block, next)``; none is used twice, the first pair wins."""

    def pair(xs: Column) -> Column:
        marked = F.transform(xs, lambda x, i: F.struct(x.alias("x"), F.coalesce((i + 1 < F.size(xs)) & joins(x, F.get(xs, i + 1)), F.lit(False)).alias("on")))
        # in a run of blocks that would all join their next, every second one does
        groups = runs(marked, lambda m, p: m["on"] != p["on"])
        flags = F.flatten(F.transform(groups, lambda g: F.transform(g, lambda m, k: m["on"] & (k % 2 == 0))))
        merged = lambda fs: F.transform(xs, lambda x, i: F.when(F.get(fs, i), joined(x, F.get(xs, i + 1))).when(F.coalesce(F.get(fs, i - 1), F.lit(False)), F.lit(None)).otherwise(x))
        return F.filter(bound(flags, merged), lambda x: x.isNotNull())

    return F.when(F.size(blocks) > 0, bound(blocks, pair)).otherwise(blocks)


def _joined(action: str):
    def join(a: Column, b: Column) -> Column:
        return _block(a, action, text=F.trim(F.concat(F.rtrim(a["text"]), F.lit(" "), F.ltrim(b["text"]))), lines=a["lines"] + b["lines"], merged=a["merged"] + b["merged"])

    return join


def _chars(b: Column) -> Column:
    return F.char_length(F.trim(b["text"]))


def numerals_joined(blocks: Column) -> Column:
    """A numeral that stands alone made one heading with the short title after it."""
    joins = lambda a, b: F.trim(a["text"]).rlike(NUMERAL) & (_chars(b) <= TITLE) & b["block_type"].isin("paragraph", "heading")
    heading = lambda a, b: _block(a, "merged_ascii_roman_heading", block_type=F.lit("heading"), text=F.concat(F.trim(a["text"]), F.lit(" "), F.trim(b["text"])), merged=a["merged"] + b["merged"])
    return pairs_joined(blocks, joins, heading)


def labels_compact(blocks: Column) -> Column:
    """Labels of spaced syllables without the spaces; other white space as one space.  What has been made a heading stays as it is."""
    text = lambda b: F.when(F.trim(b["text"]).rlike(SPACED_LABEL), F.replace(F.trim(b["text"]), F.lit(" "), F.lit(""))).otherwise(F.regexp_replace(F.trim(b["text"]), r"\s+", " "))
    fresh = lambda b: F.size(b["actions"]) == 0
    return F.transform(blocks, lambda b: F.when(fresh(b) & (text(b) != b["text"]), _block(b, "normalized_compact_label", text=text(b))).otherwise(b))


def from_main_heading(blocks: Column, words: Words) -> Column:
    """The blocks from the first main heading on; all if there is none."""
    at = lambda xs: F.array_position(F.transform(xs, lambda b: (b["block_type"] == "heading") & b["text"].rlike(words.main_heading)), F.lit(True)).cast("int")
    return bound(blocks, lambda xs: F.when(at(xs) > 1, F.slice(xs, at(xs), F.size(xs))).otherwise(xs))


def is_cover(blocks: Column) -> Column:
    """Whether a section is a small cover: few blocks, no bullets, notes or citations, nearly all short."""
    short = F.size(F.filter(blocks, lambda b: _chars(b) <= SMALL))
    return (F.size(blocks) <= COVER_BLOCKS) & ~F.exists(blocks, lambda b: b["block_type"].isin("bullet", "note", "citation")) & (short >= F.greatest(F.lit(5), F.size(blocks) - 1))


def headings_promoted(blocks: Column, words: Words) -> Column:
    """Short paragraphs before a bullet or note made headings; then labels before what isn't a label."""
    is_label = lambda b: F.trim(b["text"]).rlike(words.label)

    def promoted(holds, action: str):
        return lambda xs: F.transform(xs, lambda b, i: F.when(F.coalesce((b["block_type"] == "paragraph") & holds(b, F.get(xs, i + 1)), F.lit(False)), _block(b, action, block_type=F.lit("heading"))).otherwise(b))

    short = lambda b, n: (_chars(b) <= HEADING) & ((_chars(b) > BARE_HEADING) | b["text"].rlike(r"\d")) & n["block_type"].isin("bullet", "note")
    label = lambda b, n: is_label(b) & n["block_type"].isin("paragraph", "bullet", "note", "heading") & ~is_label(n)
    return bound(bound(blocks, promoted(short, "promoted_short_heading")), promoted(label, "promoted_compact_label_heading"))


def stitched(blocks: Column) -> Column:
    """Notes that end open joined with the item after them, and short captions with a colon joined with the short paragraph after them."""
    note = lambda a, b: (a["block_type"] == "note") & b["block_type"].isin("paragraph", "heading") & F.rtrim(a["text"]).rlike("[,·→]$") & F.trim(b["text"]).rlike(ITEM)
    caption = lambda a, b: (a["block_type"] == "paragraph") & (b["block_type"] == "paragraph") & F.contains(a["text"], F.lit(":")) & ~F.contains(b["text"], F.lit(":")) & (_chars(a) <= CAPTION) & (_chars(b) <= CAPTION)
    join = lambda a, b: F.when(note(a, b), _joined("merged_note_continuation")(a, b)).otherwise(_joined("merged_caption_continuation")(a, b))
    return pairs_joined(blocks, lambda a, b: note(a, b) | caption(a, b), join)


def without_contacts(blocks: Column) -> Column:
    """The blocks before the last contact line, and before the short paragraphs that lead to it."""

    def cut(xs: Column) -> Column:
        is_contact = F.transform(F.reverse(xs), lambda b: F.trim(b["text"]).rlike(CONTACT))
        head = lambda k: F.slice(xs, 1, F.size(xs) - k)

        def trimmed(k: Column) -> Column:
            back = F.transform(F.reverse(head(k)), lambda b: (b["block_type"] == "paragraph") & (_chars(b) <= CONTACT_LINE))
            leads = bound(F.array_position(back, F.lit(False)).cast("int"), lambda p: F.when(p > 0, p - 1).otherwise(F.size(xs) - k))
            return F.slice(xs, 1, F.size(xs) - k - leads)

        return bound(F.array_position(is_contact, F.lit(True)).cast("int"), lambda k: F.when(k > 0, trimmed(k)).otherwise(xs))

    return bound(blocks, cut)


def without_fragments(blocks: Column, words: Words) -> Column:
    """The blocks without runs of three or more short fragments, or of two or more that look like cells of a table."""
    text = lambda b: F.trim(b["text"])
    small = lambda b: (
        b["block_type"].isin("paragraph", "heading") & (_chars(b) <= FRAGMENT) & ~text(b).rlike(rf"\d|{BULLET}") & ~text(b).rlike(NUMERAL) & ~text(b).rlike(words.main_heading)
    )
    gone = lambda r: small(r[0]) & ((F.size(r) >= 3) | (F.size(r) >= 2) & F.forall(r, lambda b: _chars(b) <= CELL))
    groups = runs(blocks, lambda b, p: small(b) != small(p))
    return F.coalesce(F.flatten(F.filter(groups, lambda r: ~gone(r))), F.slice(blocks, 1, 0))


def cleaned(blocks: Column, words: Words = Words()) -> Column:
    """A section's blocks after all passes; a small cover has none left."""
    main = bound(labels_compact(numerals_joined(blocks)), lambda xs: from_main_heading(xs, words))
    kept = bound(main, lambda xs: F.when(is_cover(xs), F.slice(xs, 1, 0)).otherwise(xs))
    return without_fragments(without_contacts(stitched(headings_promoted(kept, words))), words)
