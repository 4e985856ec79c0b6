import re
import unicodedata

from pyspark.sql import functions as F

from docloom.operators import textops


def test_match_key_nfkc(spark):
    rows = ["Plain Text", "\uff26\uff55ll W", "\ufb01ne", "Cafe\u0301 \u00bd", "\u1112\u1161\u11ab\uae00", "Stra\u00dfe \u20ac5", "", None]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select(textops.match_key(F.col("t")).alias("k")).collect()
    assert [r["k"] for r in got] == [None if t is None else "".join(unicodedata.normalize("NFKC", t).lower().split()) for t in rows]


def test_normal_characters():
    inside = [c for c in map(chr, range(0xD800)) if re.match(f"[{textops._NORMAL}]", c)]
    assert all(unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) for c in inside)
