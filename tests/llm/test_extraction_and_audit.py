"""Fill-in-the-middle, main text and source divergence: against plain versions, SQL, and odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import divergence, infill, main_text, queries, radix
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_html_extraction", "op13_source_divergence"])
def test_rows_equal_sql(spark, name):
    assert compare(spark, SF, queries.queries()[name], queries.oracle_sql()[name]) > 0


# 11


def plain_infill(doc_id, text, s=infill.Setting()):
    text = text or ""
    units = re.findall(infill.UNIT, text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{s.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, z = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in s.sentinels) or h[2] % 100 >= s.percent:
        return n, "plain", None, None, text
    if h[3] % 100 < s.spm_percent:
        return n, "spm", len(p), len(m), s.suffix + z + s.prefix + p + s.middle + m
    return n, "psm", len(p), len(m), s.prefix + p + s.suffix + z + s.middle + m


@pytest.mark.parametrize("setting", [infill.Setting(), infill.Setting(7, 100, 50, "<|pre|>", "<|suf|>", "<|mid|>")])
def test_infill_equals_plain(spark, setting):
    texts = [None, "", " \n\t", "one", "a b", "<P> there", "ends <", "> begins", "x <S", "\x0b é　ß 中文 \U0001f600 x\r\n", "word " * 30_000, "<|suf|>"]
    rows = [(i, t) for i in range(12) for t in texts] + [(None, "null id and more words"), (3, "one"), (3, "one")]
    df = spark.createDataFrame([(i, t, "c", [1], 2) for i, t in rows], "doc_id long, text string, units string, h array<int>, form int")
    made = infill.arranged(df, setting).withColumn("back", infill.restored(F.col("output"), F.col("form"), setting))
    got = sorted((repr((r["doc_id"], r["n"], r["form"], None if r["prefix"] is None else len(r["prefix"]), None if r["middle"] is None else len(r["middle"]), r["output"], r["back"])) for r in made.collect()))
    assert got == sorted(repr((i, *plain_infill(i, t, setting), t or "")) for i, t in rows)
    assert infill.arranged(df.limit(0), setting).count() == 0
    assert {r["form"] for r in made.collect()} == {"plain", "psm", "spm"}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_sentinels_must_be_told_apart():
    for wrong in ({"prefix": "<S>"}, {"middle": "M"}, {"middle": "<<M>"}):
        with pytest.raises(ValueError):
            infill.Setting(**wrong)


# 12

BODY = "".join(f"<p>Paragraph {k} says <b>some</b>thing about <a href='/x'>a link</a> &amp; more words to be long enough.</p>\n" for k in range(4))
WANT = " ".join(f"Paragraph {k} says something about a link & more words to be long enough." for k in range(4))
PAGES = {
    "article": (f"<html><head><title>T</title><script>var x='</p><article>';</script></head><body><header>Site</header><nav><ul><li><a>Home</a></ul></nav><main><article><h1>Head</h1>{BODY}<aside>Side</aside><form><label>Mail</label></form></article></main><footer>Foot</footer>", f"Head {WANT}"),
    "soup": (f"<body><div class='top-nav'><a href=1>One</a> <a href=2>Two</a></div><div><a href=3>Three links in a row that are long enough to count as text if they were any</a></div><div id=content><h2>Head</h2>{BODY}</div><div class='reader-comments'><p>{'I say so. ' * 90}</p></div><div id='footer'>Foot of it all</div>", f"Head {WANT}"),
    "unclosed": ("<article><h1>A<p><b>One<br>two<p>three<div class=ad>Buy</div>four</article>tail", "A One two three four"),
    "comments": (f"<div class='page with-sidebar'><article class='post'>{BODY}<footer>by me</footer></article><div id=comments><article class='comment-body'><p>{'No. ' * 200}</p></article></div></div>", WANT),
    "wrapped": (f"<div class=banner><main>{BODY}</main></div>", WANT),
    "own header": ("<article><header><h1>Title</h1></header><p>Text</p></article>", "Title Text"),
    "entities": ("<main>a&nbsp;b &lt;p&gt; &#x41;&#66; &eacute;<!-- <p>no</p> --><p>x\n\t y</p></main>", "a b <p> AB é x y"),
    "notice": (f"<div role=dialog>We use cookies.</div><section class='cookieNotice'>{'Accept them all, please. ' * 20}</section><div>{BODY}</div>", WANT),
    "short": ("<body><p>Only this.</p></body>", "Only this."),
    "links only": ("<ul><li><a>One</a></li><li><a>Two</a></li></ul>", "One Two"),
    "none": ("<html><head><title>T</title></head><body><nav>x</nav></body></html>", ""),
    "open comment": ("<p>text</p><!-- never ends <p>x</p>", "text"),
    "less than": ("<article>1 < 2 and <3 hearts</article>", "1 < 2 and <3 hearts"),
    "quoted": ("<article title='a > b'>x<p data-x=\"</article>\">y</article>z", "x y"),
    "table": ("<main><table><tr><td>a<td>b<tr><td>c</table></main>", "a b c"),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_main_text(name):
    page, want = PAGES[name]
    assert main_text.main_text(page) == want


def test_blocks_surge_and_dive():
    assert main_text.stretch([]) == (0, 0)
    assert main_text.stretch([0, 0, 5, 0]) == (2, 3)
    assert main_text.stretch([9, 0, 0, 0, 50, 90, 3, 0, 60, 0, 0, 0, 4]) == (4, 9)  # short lines before and after stay out, one gap is no dive
    assert main_text.stretch([500, 0, 0, 300, 0, 0, 90, 0, 0, 400]) == (0, 10)  # what lies between two large stretches stays


def test_pages_of_any_size(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (3, "u", "<article>" + "<p>word word.</p>" * 50_000 + "</article>"), (4, "u", "<div>" * 5_000 + "deep"), (5, "u", "<" * 100_000), (5, "u", "<a " * 50_000), (6, "u", "<a b=\"> </q>" * 50_000 + "x</b>" + "</i>" * 50_000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"] or 0, r["url"], r["text"][:9], r["n_chars"]) for r in main_text.extracted(df).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (0, "u", "x", 1), (3, "u", "word word", 550_000 - 1), (4, "u", "deep", 4), (5, "u", "<" * 9, 100_000), (5, "u", "<a <a <a ", 150_000 - 1), (6, "u", "x", 1)], key=repr)
    assert main_text.extracted(df.limit(0)).count() == 0


# 13


def plain_audit(rows, least=3, most=200):
    words = [(g or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for g, s, t in rows]
    docs, counts = Counter(), defaultdict(Counter)
    for g, s, w in words:
        docs.update((g, x) for x in set(w))
        counts[g, s].update(w)
    out = []
    for g in {g for g, *_ in words}:
        kept = sorted(x for (h, x), n in docs.items() if h == g and n >= least)
        own = {s: {x: c[x] for x in kept} for (h, s), c in counts.items() if h == g}
        whole = {x: sum(c[x] for c in own.values()) for x in kept}

        def share(c):
            return {x: 1 + 10**9 * (c[x] + 1) // (sum(c.values()) + len(kept)) for x in kept}  # noqa: B023

        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            pairs = [(sum((p[s][x] - p[t][x]) ** 2 // p[t][x] for x in kept), t) for t in own if t != s]
            terms = [((p[s][x] - q[x]) ** 2 // q[x], x) for x in kept if own[s][x] > 0 and p[s][x] > q[x]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda z: (-z[0], z[1].encode()))
                out += [(g, s, part, i, v, k) for k, (v, i) in enumerate(found, 1) if part == "pair" or k <= most]
    return sorted(out)


def audited(df, **how):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(df, **how).collect())


def test_divergence_equals_plain(spark):
    rng = random.Random(11)
    vocabulary = ["a", "ab", "abc", "abd", "B", "zß", "中文", "\U0001f600x", "é", "the", "then", "x" * 40 + "y", "x" * 40 + "z", "x" * 40]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None]), " 1,".join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for _ in range(300)]
    rows += [("en", "bare", None), ("en", "digits", "12 3"), ("fr", "one", "un deux"), ("fr", "two", ""), rows[0], rows[0], ("en", "s1", "The " * 2_000_000)]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, source string, text string, n int, prefix string")
    want = plain_audit(rows)
    assert audited(df) == want
    assert audited(df, leaves=3) == want  # cut byte by byte down to whole terms
    assert audited(df, most=2, least=20) == plain_audit(rows, 20, 2)
    assert audited(df.limit(0)) == []
    assert any(v > 0 for *_, v, _ in want)


def test_counts_become_several_tries(monkeypatch):
    monkeypatch.setattr(divergence, "ENTRIES", 50)
    monkeypatch.setattr(divergence, "PIECE", 10)
    texts = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)} many same again" for k in range(400)]
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"] * 40), pa.array([f"s{k % 3}"] * 40), pa.array(texts[k : k + 40])], ["lang", "source", "text"]) for k in range(0, 400, 40)]
    rows = [x for b in divergence._counted(batches) for x in divergence._read(b)]
    tries = [t for r, t in rows if r["prefix"] == b"ma"]
    assert len(tries) > 1
    keys, whole = radix.merged(tries)
    assert keys == [b"many"] and whole.docs.tolist() == [400] and whole.count.sum() == 400
    same = sum(int(t.count.sum()) for r, t in rows if r["prefix"] == b"sa")
    assert same == 400


def test_tries_cut_and_merge():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 40))).encode() for _ in range(500)} | {b"a" * 20, b"a" * 30, b"a" * 30 + b"b"})
    docs = {w: rng.randint(1, 9) for w in words}
    counts = [{w: rng.randint(1, 5) for w in rng.sample(words, 300)} for _ in range(3)]
    keys, trie = radix.of_counts(docs, counts)
    assert keys == words and trie.keys() == words and radix.Trie.unpacked(*trie.packed()).keys() == words
    parts = list(trie.cut(3))
    assert [p for p, _ in parts] == sorted({w[:3] for w in words})
    assert [k for _, t in parts for k in t.keys()] == words
    again, whole = radix.merged([t for _, t in reversed(parts)] + [trie])
    assert again == words and whole.docs.tolist() == [2 * docs[w] for w in words]
    at = 0
    for w, n in zip(words, whole.sizes.tolist(), strict=True):
        assert {int(c): int(v) for c, v in zip(whole.code[at : at + n], whole.count[at : at + n], strict=True)} == {k: 2 * c[w] for k, c in enumerate(counts) if w in c}
        at += n


def test_shares_beyond_64_bits():
    count = np.array([0, 9_000_000_001, 10**15], np.int64)
    assert divergence.shares(count, 2 * 10**15).tolist() == [1 + 10**9 * (int(c) + 1) // (2 * 10**15) for c in count]


def test_named_article_keeps_short_sections():
    """Where a page names its article, short sections at its ends stay, however long the others are."""
    page = "<main><div><p>First.</p></div><div></div><div></div><div><p>" + "long text " * 200 + "</p></div><div></div><div></div><div><p>Last.</p></div></main>"
    weight = [len(x.text) for x in main_text.lines_of(page)]
    assert sum(weight[slice(*main_text.stretch(weight))]) < sum(weight)  # what the defaults would drop
    text = main_text.main_text(page)
    assert text.startswith("First. long") and text.endswith("text Last.")
