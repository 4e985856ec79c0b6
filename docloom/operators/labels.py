"""Labels, summaries, keys and readable forms of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.operators.fields import text_of
from docloom.operators.textops import bound, nfkc

#: Marks before a listed text, and what a text copied from a source begins with.
LEAD = r"(?:[ㅇ○□-] |[➊➋①②③])"
#: What counts as a dash, a middle dot, a tilde or a quote when texts are compared.
DASHES = "•◦▪▸▹►▻󰊱󰊲󰊳󰊴󰊵󰊶–—―−‐‑"
DOTS, TILDES, DOUBLES, SINGLES = "․ㆍ‧∙", "∼～〜", "“”‟", "’‘‚‛"
ZERO_WIDTH = "[​-‍﻿]"


def collapsed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text_of(text), r"(?U)\s+", " "))


def compare_key(text: Column) -> Column:
    """NFKC, with dashes, dots, tildes and quotes made alike, without zero-width signs and white space."""
    alike = F.translate(nfkc(text_of(text)), DASHES + DOTS + TILDES + DOUBLES + SINGLES, "-" * len(DASHES) + "·" * len(DOTS) + "~" * len(TILDES) + '"' * len(DOUBLES) + "'" * len(SINGLES))
    return F.regexp_replace(F.regexp_replace(alike, ZERO_WIDTH, ""), r"(?U)\s+", "")


def without_private_use(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Co}", "-")


def cut(text: Column, most: int, kept: int, mark: str = "...", trimmed: bool = True) -> Column:
    """A text of over ``most`` characters as its first ``kept`` ones and a mark."""
    head = lambda t: F.rtrim(F.substring(t, 1, kept)) if trimmed else F.substring(t, 1, kept)
    return bound(text, lambda t: F.when(F.char_length(t) > most, F.concat(head(t), F.lit(mark))).otherwise(t))


def label(text: Column, most: int = 48, kept: int = 45, retry: bool = True) -> Column:
    """What stands in the first parentheses, else the text without marks up to the first comma, colon or semicolon.

    ``retry``: a label of fewer than two characters is taken again from the
    text, up to a full stop or middle dot too.
    """

    def first(whole: Column) -> Column:
        before = lambda signs: F.trim(F.split(F.regexp_replace(whole, r"^(?:[-*•□○ㅇ▪]\s*)+", ""), signs)[0])
        out = bound(F.trim(F.regexp_extract(whole, r"\(([^()]+)\)", 1)), lambda inner: F.when(inner != "", inner).otherwise(before("[,:;]")))
        return bound(out, lambda x: F.when(F.char_length(x) < 2, before("[,.·;:]")).otherwise(x)) if retry else out

    return cut(bound(collapsed(text), first), most, kept)


#: The four lengths of summaries, as (most, kept, mark, trimmed).
SUMMARIES = {"short": (150, 147, "...", True), "reviewed": (180, 177, "...", True), "preview": (220, 217, "...", False), "proxy": (180, 179, "…", True)}


def summary(text: Column, kind: str = "short") -> Column:
    return cut(collapsed(text), *SUMMARIES[kind])


def slug(text: Column, default: str = "item") -> Column:
    """Letters, digits and Hangul with single dashes between."""
    out = F.trim(F.regexp_replace(F.lower(text_of(text)), r"[^0-9a-z가-힣]+", "-"), F.lit("-"))
    return F.when(out == "", default).otherwise(out)


def label_tokens(text: Column, generic: list[str] = ()) -> Column:
    """A label's words in match-key form, without generic ones and single characters."""
    words = F.transform(F.split(text_of(text), r"[·(),/\- ]+"), lambda w: F.regexp_replace(F.lower(w), r"(?U)\s+", ""))
    return F.filter(words, lambda w: (F.char_length(w) >= 2) & ~F.array_contains(F.array(*map(F.lit, generic)) if generic else F.expr("array('')"), w))


def keywords(terms: Column) -> Column:
    """The sorted distinct words of at least two letters or digits in an array of terms."""
    words = F.flatten(F.transform(terms, lambda t: F.split(F.lower(t), r"[^0-9a-z가-힣]+")))
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: F.char_length(w) >= 2)))


def spaced(text: Column) -> Column:
    """A space wherever Hangul meets Latin letters or digits."""
    return F.regexp_replace(F.regexp_replace(text, r"(?<=[가-힣])(?=[A-Za-z0-9])", " "), r"(?<=[A-Za-z0-9])(?=[가-힣]{2})", " ")


def without_lead(text: Column) -> Column:
    """The text without list marks at its beginning, however many."""
    return F.trim(F.regexp_replace(collapsed(text), rf"^(?:{LEAD}\s*)+", ""))


def looks_raw(text: Column) -> Column:
    """Whether a text reads like a copied source line: empty, with a list mark or parenthesis first, or long with hardly any space."""
    t = collapsed(text)
    few = F.char_length(t) - F.char_length(F.replace(t, F.lit(" "), F.lit(""))) <= 3
    return (t == "") | t.rlike(rf"^(?:{LEAD}|\()") | ((F.char_length(t) >= 45) & few)


def _final(text: Column) -> Column:
    """Whether the last character is a Hangul syllable that ends in a consonant."""
    code = F.ascii(F.right(collapsed(text), F.lit(1)))
    return F.coalesce((code >= 0xAC00) & (code <= 0xD7A3) & ((code - 0xAC00) % 28 != 0), F.lit(False))


def topic_particle(text: Column) -> Column:
    return F.when(_final(text), "은").otherwise("는")


def object_particle(text: Column) -> Column:
    return F.when(_final(text), "을").otherwise("를")


#: How places in a document are named.
PLACES = {"unknown": "위치 정보 확인", "document": "문서 위치", "front": "문서 앞부분", "middle": "문서 중간", "back": "문서 후반부", "page": "페이지", "suffix": "쪽"}


def location(value: Column) -> Column:
    """A page number or section as a readable place; anything else stays."""
    raw = collapsed(value)
    low, digits = F.lower(raw), F.regexp_replace(raw, "[^0-9]", "")
    number = digits.cast("decimal(38,0)")
    section = F.when(digits == "", PLACES["document"]).when(number <= 1, PLACES["front"]).when(number <= 3, PLACES["middle"]).otherwise(PLACES["back"])
    page = F.when(digits == "", PLACES["page"]).otherwise(F.concat(digits, F.lit(PLACES["suffix"])))
    return F.when(raw == "", PLACES["unknown"]).when(raw.rlike("^[0-9]+$"), page).when(low.startswith("section"), section).when(low.startswith("page"), page).otherwise(raw)


def html_escaped(text: Column) -> Column:
    out = text_of(text)
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def is_generic_caption(caption: Column, kind: str = "image") -> Column:
    """Whether a caption says nothing: empty, or the kind with a number."""
    return F.trim(text_of(caption)).rlike(rf"(?i)^(?:{kind}[ _-]*[0-9]*)?$")
