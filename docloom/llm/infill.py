"""Fill-in-the-middle arrangements of whole documents, and texts rebuilt from them.

Native Spark SQL throughout: ``regexp_extract_all`` makes the array of units,
``conv`` over parts of a SHA-256 gives the cuts, ``slice`` and ``array_join``
build the arrangement, and a split at the sentinels restores the text.  A row
needs nothing of another one: no shuffle, and it comes out the same on
whichever executor and however often it is made.

A null text counts as the empty one, which is always plain; a null id counts as
no digits after the seed.  A text that holds a sentinel stays plain, as it
couldn't be told apart from an arrangement.  Repeated rows give equal rows.
Very long texts are cut whole.  An empty table gives an empty one.  Columns
other than the id and the text are left out, so their names can't clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space with the word after it, or white space at the end.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Setting:
    """The seed, the percentage of texts that are rearranged, and of those the percentage in the order suffix, prefix, middle.

    The sentinels are of one form ``<X>`` and differ, so none can begin inside
    a text and end inside a sentinel, or the other way round.
    """

    seed: int = 42
    percent: int = 50
    spm_percent: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        if len({self.prefix, self.suffix, self.middle}) < 3 or not all(re.fullmatch(r"<[^<>]+>", s) for s in self.sentinels):
            raise ValueError("sentinels differ and have the form <X>")

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    @property
    def any_sentinel(self) -> str:
        """A pattern of them all; only what Java and Python read alike is left bare."""
        return "|".join(re.sub(r"([^\w<>])", r"\\\1", s) for s in self.sentinels)


def draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit integers that follow from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)))


def arranged(df: DataFrame, setting: Setting = Setting(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n, form, prefix, middle, suffix, output): each text's units cut in three and put in a form's order.

    ``form`` is plain, psm or spm; the parts of a plain text are null and its
    output is the text.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("units", F.regexp_extract_all("text", F.lit(UNIT), F.lit(0))).withColumn("h", draws(F.col("doc_id"), setting.seed))
    rows = rows.withColumn("n", F.size("units").cast("long"))
    cuts = [F.expr(f"cast(h[{k}] % (n + 1) as int)") for k in (0, 1)]
    rows = rows.withColumn("a", F.least(*cuts)).withColumn("b", F.greatest(*cuts))
    plain = (F.col("text") == "") | F.col("text").rlike(setting.any_sentinel) | (F.col("h")[2] % 100 >= setting.percent)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("h")[3] % 100 < setting.spm_percent, "spm").otherwise("psm"))
    whole = F.col("form") == "plain"

    def part(first: Column, length: Column) -> Column:
        return F.when(~whole, F.array_join(F.slice("units", first, length), ""))

    rows = rows.select(
        "doc_id",
        "text",
        "n",
        "form",
        part(F.lit(1), F.col("a")).alias("prefix"),
        part(F.col("a") + 1, F.col("b") - F.col("a")).alias("middle"),
        part(F.col("b") + 1, F.size("units") - F.col("b")).alias("suffix"),
    )
    p, s, m = map(F.lit, setting.sentinels)
    psm, spm = F.concat(p, "prefix", s, "suffix", m, "middle"), F.concat(s, "suffix", p, "prefix", m, "middle")
    return rows.withColumn("output", F.when(whole, F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm))


def restored(output: Column, form: Column, setting: Setting = Setting()) -> Column:
    """The text of an arrangement, from its output and form alone: what follows each sentinel, put in the text's order."""
    part = F.split(output, setting.any_sentinel, -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1]))
