"""Scores of texts against a vocabulary by containment in the normalised text."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_key(word: str) -> str:
    """The match key of a vocabulary word, made on the driver: NFKC, lower case, no white space."""
    return "".join(unicodedata.normalize("NFKC", word or "").lower().split())


@dataclass(frozen=True)
class Term:
    """A vocabulary entry: label, aliases, aliases of policies that speak for it, and the domain that has it as a prior."""

    label: str
    aliases: tuple[str, ...] = field(default=())
    policy_aliases: tuple[str, ...] = field(default=())
    prior_of: str | None = None


@dataclass(frozen=True)
class Weights:
    """Points of each kind of hit; label words count up to ``most_words``."""

    label: int = 8
    word: int = 2
    most_words: int | None = 3
    alias: int = 3
    focus: int = 1
    policy: int = 4
    prior: int = 4


def words_of_label(label: str, generic: frozenset[str] = frozenset(), least: int = 2) -> list[str]:
    keys = (plain_key(w) for w in re.split(r"[·(),/\- ]+", label))
    return [k for k in keys if len(k) >= least and k not in generic]


def is_telling(word: str) -> bool:
    """Whether an alias in the focus text is worth a point more: with a Latin letter or digit, or three characters."""
    key = plain_key(word)
    return bool(re.search("[a-z0-9]", key)) or len(key) >= 3


def _hits(key: Column, words) -> Column:
    """How many of the words the key holds; empty words never count."""
    total = F.lit(0)
    for w in words:
        if w:
            total = total + F.coalesce(F.contains(key, F.lit(w)), F.lit(False)).cast("int")
    return total


def points(
    term: Term,
    key: Column,
    weights: Weights = Weights(),
    title: Column | None = None,
    focus: Column | None = None,
    prior: Column | None = None,
    title_only: bool = False,
    generic: frozenset[str] = frozenset(),
    least_word: int = 2,
) -> Column:
    """A text's points for a term.

    ``key``, ``title`` and ``focus`` are match keys.  Policy aliases count in
    the title or, unless ``title_only``, in the text; a prior counts where the
    row's ``prior`` is the term's domain.
    """
    out = _hits(key, [plain_key(term.label)]) * weights.label
    if weights.word:
        words = _hits(key, words_of_label(term.label, generic, least_word))
        out = out + (F.least(words, F.lit(weights.most_words)) if weights.most_words is not None else words) * weights.word
    out = out + _hits(key, map(plain_key, term.aliases)) * weights.alias
    if focus is not None:
        both = [plain_key(a) for a in term.aliases if is_telling(a)]
        for a in both:
            out = out + (_hits(key, [a]) * _hits(focus, [a])) * weights.focus
    if title is not None:
        for a in filter(None, map(plain_key, term.policy_aliases)):
            there = _hits(title, [a]) if title_only else F.greatest(_hits(title, [a]), _hits(key, [a]))
            out = out + there * weights.policy
    if prior is not None and term.prior_of:
        out = out + F.coalesce(prior == term.prior_of, F.lit(False)).cast("int") * weights.prior
    return out


def scored(key: Column, vocabulary: list[Term], title: Column | None = None, focus: Column | None = None, prior: Column | None = None, **how) -> Column:
    """The terms with points, as an array by points, then by order in the vocabulary.

    The vocabulary is a parameter and goes into the plan as expressions: no
    join with the texts, no shuffle; what is best is taken from the array.
    The keys are bound to a lambda's variable, so each is made once a row and
    not once a word.
    """
    given = {"title": title, "focus": focus, "prior": prior}
    row = F.struct(key.alias("key"), *(c.alias(n) for n, c in given.items() if c is not None))

    def terms(r: Column) -> Column:
        columns = {n: r[n] for n, c in given.items() if c is not None}
        return F.array(
            *(F.struct((-points(t, r["key"], **columns, **how)).alias("minus"), F.lit(i).alias("display_order"), F.lit(t.label).alias("label")) for i, t in enumerate(vocabulary, 1))
        )

    return F.array_sort(F.filter(F.get(F.transform(F.array(row), lambda r: terms(r)), F.lit(0)), lambda x: x["minus"] < 0))


def within_margin(terms: Column, floor: int = 4, margin: int = 2, most: int = 2) -> Column:
    """Of a sorted array of terms the first ``most`` of at least max(floor, top - margin) points."""
    top = -F.get(terms, F.lit(0))["minus"]
    return F.slice(F.filter(terms, lambda x: -x["minus"] >= F.greatest(F.lit(floor), top - margin)), 1, most)


def confidence(score: Column, steps: list[tuple[int, str]], default: str | None) -> Column:
    """The name of the first step that a score reaches."""
    out = F.lit(default)
    for least, name in sorted(steps):
        out = F.when(score >= least, name).otherwise(out)
    return out


#: Confidence of an item's domain and of a paragraph's.
ITEM_STEPS, PARAGRAPH_STEPS = [(10, "high")], [(10, "high"), (6, "medium"), (4, "low")]


def unique_max(key: Column, categories: dict[str, tuple[str, ...]]) -> tuple[Column, Column]:
    """The category with the most hits and that number; no category where none hits or several tie."""
    hits = F.array(*(F.struct(_hits(key, w).alias("n"), F.lit(c).alias("c")) for c, w in categories.items()))
    most = F.array_max(F.transform(hits, lambda h: h["n"]))
    best = F.filter(hits, lambda h: h["n"] == most)
    return F.when((most > 0) & (F.size(best) == 1), F.get(best, F.lit(0))["c"]), most


def first_max(key: Column, categories: dict[str, tuple[str, ...]], fallback: list[tuple[str, tuple[str, ...]]], default: str) -> Column:
    """The category with the most hits, the first of several; where none hits, the first fallback with a hit, else ``default``."""
    hits = F.array(*(F.struct((-_hits(key, w)).alias("minus"), F.lit(i).alias("i"), F.lit(c).alias("c")) for i, (c, w) in enumerate(categories.items())))
    best = F.array_min(hits)
    rest = F.lit(default)
    for c, words in reversed(fallback):
        rest = F.when(_hits(key, words) > 0, c).otherwise(rest)
    return F.when(best["minus"] < 0, best["c"]).otherwise(rest)
