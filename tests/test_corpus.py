"""Operators that take vocabularies, shapes, hierarchies, commits and sections as data, and queries of theirs."""

import random
import re
import sqlite3
import time

import pytest
from pyspark.sql import functions as F

from docloom.operators import continuation, facets, hierarchy, lens, pagetext, resolve, scoring, sections, shapes, tables, textops, vocabulary
from docloom.plans import catalogue, corpus_oracles
from docloom.sources import commits, sinks
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


@pytest.mark.parametrize("name", sorted(corpus_oracles.SQL))
def test_rows_equal_sql(spark, name):
    assert compare(spark, SF, catalogue.queries()[name], corpus_oracles.SQL[name]) > 0


# linear array rules


def seconds(action):
    best = 1e9
    for _ in range(3):
        start = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - start)
    return best


@pytest.mark.parametrize("rule", [textops.carry_heading, lambda df: textops.short_runs(df, 2), lambda df: pagetext.page_report(df, "doc_id", "text")])
def test_array_rules_are_linear(spark, rule):
    """Eight times the lines: eight times the work at most, where it was sixty-four times."""
    line = "A longer line of more than twenty-five characters\nshort\n"
    small, large = (spark.createDataFrame([(1, line * n)], "doc_id long, text string").cache() for n in (5_000, 40_000))
    small.count(), large.count()
    times = [seconds(lambda df=df: rule(df).write.format("noop").mode("overwrite").save()) for df in (small, large)]
    assert times[1] < 16 * times[0] + 1
    assert rule(small).count() > 0


def test_runs_against_a_loop(spark):
    rng = random.Random(5)
    data = [[rng.randint(0, 3) for _ in range(rng.randint(0, 30))] for _ in range(60)] + [None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(data)], "k int, x array<int>")
    got = {r["k"]: r["g"] for r in df.select("k", textops.runs(F.col("x"), lambda x, p: x < p).alias("g")).collect()}
    for k, x in enumerate(data):
        want = None
        for y in x or []:
            if want is None or y < want[-1][-1]:
                want = [*(want or []), [y]]
            else:
                want[-1].append(y)
        assert got[k] == want


# vocabularies


def test_vocabulary_of_fifty_thousand(spark):
    rng = random.Random(9)
    syllables = ["ka", "lo", "mi", "ren", "tas", "ü", "가", "x"]
    words = sorted({"".join(rng.choices(syllables, k=rng.randint(1, 8))) for _ in range(200_000)})[:50_000]
    texts = [(k, "".join(rng.choices(syllables, k=rng.randint(0, 3_000)))) for k in range(12)] + [(98, ""), (99, None)]
    df, keys = spark.createDataFrame(texts, "i int, t string"), spark.createDataFrame([(w,) for w in [*words, "", None, words[0]]], "key string")
    want = sorted((k, w) for k, t in texts for w in words if t and w in t)
    assert len(words) == 50_000 and len(want) > 10_000
    assert rows(vocabulary.held(df, ["i"], "t", keys)) == want
    few = keys.filter("key < 'km'")
    assert rows(vocabulary.held(df, ["i"], "t", few, broadcast_bytes=0)) == [x for x in want if x[1] < "km"]
    assert rows(vocabulary.held(df, ["i"], "t", keys.limit(0))) == []


def test_vocabulary_points_equal_expressions(spark):
    rng = random.Random(2)
    parts = ["ai", "data", "policy", "grid", "전략", "인재", "ab"]
    term = lambda: " ".join(rng.sample(parts, rng.randint(1, 3)))
    terms = [scoring.Term(term(), tuple(term() for _ in range(rng.randint(0, 3))), tuple(term() for _ in range(rng.randint(0, 2))), rng.choice([None, "d1", "d2"])) for _ in range(12)]
    terms = [t for k, t in enumerate(terms) if t.label not in {u.label for u in terms[:k]}]
    data = [(k, "".join(rng.choices(parts, k=rng.randint(0, 6))), rng.choice(["", "aidata", "전략", None]), rng.choice(["d1", "d2", None])) for k in range(80)]
    df = spark.createDataFrame(data, "i int, key string, title string, prior string")
    table = vocabulary.vocabulary_rows(spark, terms)
    for only in (False, True):
        want = df.select("i", F.explode(scoring.scored(F.coalesce("key", F.lit("")), terms, title=F.coalesce("title", F.lit("")), focus=F.coalesce("title", F.lit("")), prior=F.col("prior"), title_only=only)).alias("s"))
        want = rows(want.select("i", "s.label", "s.display_order", (-F.col("s.minus")).alias("score")))
        assert rows(vocabulary.scores(df, "i", table, "key", "title", "prior", title_only=only)) == want


# keyed writes


@pytest.mark.parametrize("seed", range(4))
def test_replace_equals_sqlite(spark, seed):
    rng = random.Random(seed)
    value = lambda n: rng.choice([None, *map(str, range(n))])
    con = sqlite3.connect(":memory:")
    con.execute("create table t (k text unique, u text unique, a text, b text, v int, unique (a, b))")
    put = "insert or replace into t values (?, ?, ?, ?, ?)"
    for k in range(30):
        con.execute(put, (value(15), value(15), value(4), value(4), -k))
    base = con.execute("select * from t").fetchall()
    fresh = [(value(15), value(15), value(4), value(4), k) for k in range(60)]
    con.executemany(put, fresh)
    schema = "k string, u string, a string, b string, v int"
    got = sinks.replaced(spark.createDataFrame(base, schema), spark.createDataFrame([(*r, r[-1]) for r in rng.sample(fresh, 60)], schema + ", seq int"), [["k"], ["u"], ["a", "b"]], "seq")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, con.execute("select * from t").fetchall()))


# folds


def test_blocks_that_go_on(spark):
    box = lambda text, x0, y0, x1, y1, kind="paragraph": (kind, text, x0, y0, x1, y1, 600.0)
    page = [
        box("Big", 250.0, 10.0, 350.0, 22.0, "heading"), box("title", 260.0, 30.0, 340.0, 42.0),
        box("A body line that goes", 60.0, 100.0, 540.0, 112.0), box("on indented (", 90.0, 116.0, 300.0, 128.0), box("so) on", 60.0, 150.0, 90.0, 160.0),
        box("- bullet", 60.0, 172.0, 300.0, 184.0, "bullet"), box("Ends with colon:", 60.0, 300.0, 200.0, 312.0), box("x", None, 0.0, 1.0, 1.0), box(None, 1.0, 2.0, 3.0, 4.0),
    ]
    schema = "k int, blocks array<struct<block_type: string, text: string, x0: double, y0: double, x1: double, y1: double, page_width: double>>"
    got = {r["k"]: r["blocks"] for r in continuation.merged_pages(spark.createDataFrame([(1, page), (2, []), (3, None)], schema)).collect()}
    assert [(b["text"], b["block_type"], b["merged"]) for b in got[1]] == [("Big title", "heading", 2), ("A body line that goes on indented (so) on", "paragraph", 3), ("- bullet", "bullet", 1), ("Ends with colon:", "paragraph", 1), ("x", "paragraph", 1), ("", "paragraph", 1)]
    assert (got[1][1]["x0"], got[1][1]["x1"], got[1][1]["y1"]) == (60.0, 540.0, 160.0) and got[2] is None and got[3] is None
    flat = spark.createDataFrame([(7, 1, k, *b) for k, b in enumerate(page)], "doc_id int, page_no long, pos int, block_type string, text string, x0 double, y0 double, x1 double, y1 double, page_width double")
    assert [(r["pos"], r["text"]) for r in continuation.continuations_merged(flat).orderBy("pos").collect()] == [(k, b["text"]) for k, b in enumerate(got[1], 1)]


def test_tables_rebuilt(spark):
    step = tables.row_step()
    state, out = None, []
    for box in ((1, 0, 10), (1, 17, 10), (1, 30, 10), (1, 60, 10), (2, 61, 10)):
        state, n = step(state, box)
        out.append(n)
    assert out == [0, 0, 1, 2, 3]
    state, out = None, []
    for k, bits in enumerate([3, 3, 2, 0, 1, 3]):
        state, n = tables.group_step()(state, (k, bits, 2))
        out.append(n)
    assert out == [0, 0, 1, -1, 1, 0]
    cells = [("skip", "me"), ("No Name", "x"), ("a", "b"), ("", "c"), ("d", ""), ("e", "f")]
    boxes = [(1, 1, 60.0 * k, 100.0 * c + 9 * (k % 2), 12.0, f"{t} of text", 0.95) for k, r in enumerate(cells) for c, t in enumerate(r) if t]
    df = spark.createDataFrame(boxes, "id int, page_no int, y0 double, x0 double, height double, text string, score double")
    assert rows(tables.rebuilt(df, "id", [90.0], ["noname"])) == [(1, 1, ["No Name of text", "x of text"]), (1, 2, ["a of text d of text", "b of text c of text"]), (1, 3, ["e of text", "f of text"])]


# commits by document


def test_a_failing_document_fails_alone(spark, tmp_path):
    store = commits.Store(spark, str(tmp_path / "store"))
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "boom"), (4, None), (None, "x"), (1, "z")], "doc_id long, text string")

    def words(pdf):
        if (pdf["text"] == "boom").any():
            raise ValueError("no such word " * 100)
        return pdf.dropna().assign(word=lambda x: x["text"].str.split()).explode("word")[["doc_id", "word"]]

    rows_of = lambda df: commits.attempted(df, "doc_id", words, "doc_id long, word string")
    with pytest.raises(FileNotFoundError):
        store.table("words")
    got = {r["doc_id"]: r for r in store.load(docs, {"words": rows_of(docs.filter("doc_id is not null"))}).collect()}
    assert {k: r["run_status"] for k, r in got.items()} == {1: "completed", 2: "completed", 3: "failed", 4: "missing_source"}
    assert got[3]["notes"].startswith("words: ValueError: no such word") and len(got[3]["notes"]) <= commits.NOTE and got[1]["n_rows"] == 3
    assert rows(store.table("words"), "doc_id", "word") == [(1, "a"), (1, "b"), (1, "z"), (2, "c")]
    # a rerun in which 1 fails leaves its rows, and mends 3
    again = spark.createDataFrame([(1, "boom"), (2, "new"), (3, "fine")], "doc_id long, text string")
    store.load(again, {"words": rows_of(again)}, rerun=True)
    assert rows(store.table("words"), "doc_id", "word") == [(1, "a"), (1, "b"), (1, "z"), (2, "new"), (3, "fine")]
    before = store.manifest()
    with pytest.raises(Exception, match="stop"):  # a load that breaks off leaves nothing
        store.load(again, {"words": again.select("doc_id", F.raise_error(F.lit("stop")).cast("string").alias("word"))}, rerun=True)
    assert store.manifest() == before and len(list((tmp_path / "store" / "loads").iterdir())) == 2
    stale = {**before, "version": before["version"]}
    with pytest.raises(FileExistsError):
        store._publish(stale)
    store.compacted()
    assert len(store.manifest()["loads"]) == 1 and rows(store.table("words"), "doc_id", "word") == [(1, "a"), (1, "b"), (1, "z"), (2, "new"), (3, "fine")]
    assert {r["run_status"] for r in store.load(again, {"words": rows_of(again)}).collect()} == {"skipped_existing"}


def test_empty_loads(spark, tmp_path):
    store = commits.Store(spark, str(tmp_path / "store"))
    none = spark.createDataFrame([], "doc_id long, v int")
    assert store.load(none, {"t": none}).count() == 0 and store.table("t").count() == 0


# hierarchies, shapes, ids, read models


def test_rollup_counts(spark):
    rng = random.Random(4)
    paths = [tuple(rng.choice([None, 0, 1, 2]) if k else rng.choice([0, 1, None]) for k in range(4)) for _ in range(150)]
    df = spark.createDataFrame(paths, "a int, b int, c int, d int")
    got = {tuple(r[c] for c in ("level", "a", "b", "c")): tuple(r[f"n_{c}"] for c in "abcd") for r in hierarchy.rollup(df, list("abcd")).collect()}
    cut = {p[: next((k for k, x in enumerate(p) if x is None), 4)] for p in paths}
    nodes = {(k, *(*p[:k], None, None, None)[:3]) for p in cut for k in range(min(len(p), 3) + 1)}
    want = {n: tuple(None if k < n[0] else len({p[k] for p in cut if len(p) > k and p[: n[0]] == n[1 : n[0] + 1]}) for k in range(4)) for n in nodes}
    assert got == want
    assert rows(hierarchy.rollup(df.limit(0), list("abcd"))) == []
    # no path is laid out once for each pair of levels
    assert not re.search("Generate|Expand", hierarchy.rollup(df, list("abcd"))._jdf.queryExecution().optimizedPlan().toString())


def test_nested_levels(spark):
    df = spark.createDataFrame([(1, 10, 100, "x"), (1, 10, 100, "a"), (1, 11, None, None), (2, None, None, None)], "a int, b int, c int, d string")
    got = {r["a"]: r["bs"] for r in hierarchy.nested(df, [("bs", ["a"]), ("cs", ["b"]), ("ds", ["c"])], ["d"]).collect()}
    assert [(b["b"], [(c["c"], [d["d"] for d in c["ds"]]) for c in b["cs"]]) for b in got[1]] == [(10, [(100, ["a", "x"])]), (11, [])] and got[2] == []


def test_shapes(spark):
    nodes = spark.createDataFrame([("s", "A"), ("s", "A"), ("t", "A"), ("u", "B")], "subject string, class string")
    facts = spark.createDataFrame([("s", "p", "1"), ("s", "p", "1"), ("t", "p", "1"), ("t", "p", "x"), ("u", "p", "x"), ("u", "q", None)], "subject string, path string, value string")
    rules = spark.createDataFrame([("A", "p", 1, 1, "integer"), ("B", "p", 0, None, "string"), ("B", "q", 1, None, None), ("C", "p", 9, 9, None)], shapes.SHAPES)
    assert rows(shapes.violations(nodes, facts, rules), "subject", "path", "rule", "found") == [("t", "p", "datatype", 1), ("t", "p", "maxCount", 2), ("u", "q", "minCount", 0)]
    values = {"integer": ("12", "1.5"), "decimal": ("1.5", "x"), "boolean": ("true", "7x"), "date": ("2024-02-29", "2023-02-29"), "dateTime": ("2024-01-01 10:00:00", "noon")}
    for kind, (good, bad) in values.items():
        assert tuple(spark.range(1).select(shapes.fits(F.lit(good), F.lit(kind)), shapes.fits(F.lit(bad), F.lit(kind)), shapes.fits(F.lit(bad), F.lit(None))).first()) == (True, False, True)


def test_shapes_hold_no_class_or_path_in_one_task(spark, monkeypatch):
    """Against plain counts; nodes and facts aren't dealt by class or path alone, and the number of tasks follows theirs."""
    monkeypatch.setattr(shapes, "ROWS", 50, raising=False)
    rng = random.Random(5)
    classes = [(f"s{rng.randrange(90)}", rng.choice("ABX")) for _ in range(150)] + [("s0", "A"), ("s0", "B"), ("none", "A"), ("s1", None)]
    values = ["1", "-2", "1.5", "x", "2024-02-29", "true", "", None]
    stated = [(f"s{rng.randrange(90)}", rng.choice("pqrz"), rng.choice(values)) for _ in range(800)] + [("s0", "p", f"v{k}") for k in range(300)] + [(None, "p", "1"), ("s1", None, "x")]
    rules = [("A", "p", 1, 2, "integer"), ("B", "p", 2, None, "date"), ("A", "q", None, 1, "madeUp"), ("B", "q", 0, None, "boolean"), ("B", "r", 1, 1, None), ("B", "r", 1, 1, "string"), ("A", "t", 1, None, "double")]
    good = {"integer": {"1", "-2"}, "date": {"2024-02-29"}, "boolean": {"1", "true"}}
    frames = spark.createDataFrame(classes, "subject string, class string"), spark.createDataFrame(stated, "subject string, path string, value string")
    got = shapes.violations(*frames, spark.createDataFrame(rules, shapes.SHAPES))
    want = []
    for s, c in set(classes):
        for _, p, least, most, kind in (r for r in rules if r[0] == c):
            held = {v for t, q, v in stated if (t, q) == (s, p) and v is not None}
            wrong = len(held - good[kind]) if kind in good else 0
            broken = (("minCount", len(held), least is not None and len(held) < least), ("maxCount", len(held), most is not None and len(held) > most), ("datatype", wrong, wrong > 0))
            want += [(s, c, p, rule, n) for rule, n, bad in broken if bad]
    assert rows(got) == sorted(want) and ("s0", "A", "p", "datatype") in {w[:4] for w in want}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"SortMergeJoin(\(\w+\))? \[(class|path)#\d+\]", plan)
    assert set(re.findall(r"Exchange hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", plan)) == {str(len(stated) // 50 + 1)}


def test_index_of_beginnings(spark, monkeypatch):
    """Against plain search, texts put together and apart: terms of all sizes, none across two texts; places where no term begins aren't laid out as rows."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcé😀") for _ in range(n))
    data = [(k, word(rng.choice((0, 1, 5, 60)))) for k in range(80)] + [(80, None), (81, "x" * 40)]
    terms = {word(rng.randint(1, 20)) for _ in range(60)} | {t[i : i + rng.randint(1, 40)] for _, t in data if t for i in range(0, len(t), 7)} | {data[0][1] + data[1][1] + data[2][1]} - {""}
    df, keys = spark.createDataFrame(data, "i int, t string"), spark.createDataFrame([(t,) for t in terms], "key string")
    want = sorted((i, t) for i, text in data if text for t in terms if t and t in text)
    for part in (1, 1 << 18):
        monkeypatch.setattr(vocabulary, "PART", part)
        found = vocabulary.held(df, ["i"], "t", keys, broadcast_bytes=0)
        assert rows(found, "i", "key") == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_resolved_ids(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 1), ("e", 9), ("f", None), ("g", 7)], "old_id string, evidence int")
    new = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("C", 3), ("D", 4), ("D", 4), *((f"h{k}", 7) for k in range(5))], "new_id string, evidence int")
    got = rows(resolve.resolved(old, new, most_holders=4), "old_id", "new_id", "outcome")
    assert got == [("a", "A", "matched"), ("b", "B", "tied"), ("c", "D", "matched"), ("d", "A", "outbid"), ("e", None, "none"), ("f", None, "none"), ("g", None, "none")]


def test_resolved_ids_shuffle_no_pairs(spark):
    """Against plain counts, with many ids to a piece of evidence: what is shuffled grows with the evidence, not with the pairs."""
    rng = random.Random(3)
    old, new = ([(f"{side}{k}", rng.randrange(12)) for k in range(150) for _ in range(rng.randint(0, 4))] for side in "on")
    frames = spark.createDataFrame(old, "old_id string, evidence int"), spark.createDataFrame(new, "new_id string, evidence int")
    got = resolve.resolved(*frames)
    holders = {e: {x for x, f in new if f == e} for _, e in new}
    weights = {o: {} for o, _ in old}
    for o, e in set(old):
        for x in holders.get(e, ()):
            weights[o][x] = weights[o].get(x, 0) + 1_000_000 / len(holders[e])
    rounded = {o: {x: int(w + 0.5) for x, w in ws.items()} for o, ws in weights.items()}
    want = []
    for o, ws in rounded.items():
        best = sorted(x for x, w in ws.items() if w == max(ws.values()))
        bids = [w[best[0]] for w in rounded.values() if best and best[0] in w]
        outcome = "none" if not best else "tied" if len(best) > 1 else "outbid" if ws[best[0]] < max(bids) or bids.count(max(bids)) > 1 else "matched"
        want.append((o, best[0] if best else None, ws[best[0]] if best else None, outcome))
    assert rows(got, "old_id", "new_id", "weight", "outcome") == sorted(want) and len({w[3] for w in want}) >= 3
    assert not re.search(r"Window|Aggregate \[old_id#\d+, new_id#", got._jdf.queryExecution().optimizedPlan().toString())


def test_resolved_ids_by_blocks(spark):
    """Against plain counts, in few or many blocks, laid out together or id by id; the pairs are laid out once."""
    rng = random.Random(5)
    old, new = ([(k, rng.choice("abcdefghijklmnopqrstuvw")) for k in range(n) for _ in range(rng.randint(0, 6))] for n in (90, 60))
    old += [(7, x) for x in "abcdefghijklmnopqrstuvw"]
    frames = spark.createDataFrame(old, "old_id long, evidence string"), spark.createDataFrame(new, "new_id long, evidence string")
    holders = {e: {x for x, f in new if f == e} for _, e in new}
    weights = {o: {} for o, _ in old}
    for o, e in sorted(set(old)):
        for x in holders.get(e, ()):
            weights[o].setdefault(x, []).append(len(holders[e]))
    weights = {o: {x: int(sum(1_000_000 / n for n in sorted(ns)) + 0.5) for x, ns in ws.items()} for o, ws in weights.items()}
    want = []
    for o, ws in weights.items():
        best = sorted(x for x, w in ws.items() if w == max(ws.values()))
        bids = [w[best[0]] for w in weights.values() if best and best[0] in w]
        outcome = "none" if not best else "tied" if len(best) > 1 else "outbid" if ws[best[0]] < max(bids) or bids.count(max(bids)) > 1 else "matched"
        want.append((o, best[0] if best else None, ws[best[0]] if best else None, outcome))
    for sizes in ({}, {"block": 40, "pairs": 50}, {"pairs": 1}):
        got = resolve.resolved(*frames, **sizes)
        assert rows(got, "old_id", "new_id", "weight", "outcome") == sorted(want) and len({w[3] for w in want}) >= 3
    got.collect()
    assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("CartesianProduct") == 1


def test_resolved_ids_stores_no_lists(spark):
    """40 pieces of evidence that 300 ids of either side hold: what is written for shuffles grows with the 24,000 rows, not with the 7,200,000 ids in their lists."""
    held = spark.range(12_000).select((F.col("id") % 40).alias("evidence"), F.xxhash64(F.col("id") % 4_001).alias("id"))
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    before = written()
    assert resolve.resolved(held.withColumnRenamed("id", "old_id"), held.withColumnRenamed("id", "new_id")).count() == 4_001
    assert written() - before < 2_000_000


def test_read_models(spark):
    cells = spark.createDataFrame([("x", "a", 2), ("x", "z", 5), ("y", "b", 1), ("x", "a", 1)], "r string, c string, v int")
    assert [tuple(r) for r in facets.pivoted(cells, "r", "c", "v", ["b", "none", "a"]).orderBy("r").collect()] == [("x", 0, 0, 3), ("y", 1, 0, 0)]
    labels = spark.createDataFrame([(1, "전략"), (1, "인재"), (1, "apple"), (1, "Apple"), (1, "가"), (1, "가"), (1, None)], "g int, l string")
    assert [r["l"] for r in facets.collated(labels, "g", "l").orderBy("place").collect()] == ["가", "인재", "전략", "apple", "Apple"]
    links = spark.createDataFrame([("p", "1"), ("q", "1"), ("p", "2"), ("r", "1"), (None, "1"), ("p", None)], "kind string, key string")
    dims = {"p": spark.createDataFrame([(1, "one")], "key int, label string"), "q": spark.createDataFrame([("1", "uno")], "key string, label string")}
    assert sorted(map(repr, map(tuple, lens.polymorphic(links, dims).select("kind", "key", "label").collect()))) == sorted(map(repr, [("p", "1", "one"), ("q", "1", "uno"), ("p", "2", None), ("r", "1", None), (None, "1", None), ("p", None, None)]))


# sections

BLOCKS = "k int, b array<struct<block_type: string, text: string, lines: bigint, merged: bigint, actions: array<string>>>"


def blocks(*pairs):
    return [(kind, text, 1, 1, []) for kind, text in pairs]


def test_sections(spark):
    section = blocks(
        ("paragraph", "cover text"), ("heading", "추진 배경 here"), ("paragraph", "II"), ("paragraph", "Title of it"), ("paragraph", "전 략"), ("paragraph", "a long paragraph with many words, more than enough"),
        ("note", "※ one,"), ("paragraph", "① item"), ("paragraph", "a: b"), ("paragraph", "c"), ("paragraph", "Short head 1"), ("bullet", "- x"), ("paragraph", "ab"), ("paragraph", "cd"), ("bullet", "- last one"), ("paragraph", "Kim"), ("paragraph", "E-mail: x@y"),
    )
    df = spark.createDataFrame([(1, section), (2, []), (3, None), (4, blocks(*(("paragraph", c) for c in "abcdef")))], BLOCKS)
    got = {r["k"]: r["c"] for r in df.select("k", sections.cleaned(F.col("b")).alias("c")).collect()}
    assert [(b["block_type"], b["text"], b["merged"], "|".join(b["actions"])) for b in got[1]] == [
        ("heading", "추진 배경 here", 1, ""), ("heading", "II Title of it", 2, "merged_ascii_roman_heading"), ("heading", "전략", 1, "normalized_compact_label|promoted_compact_label_heading"),
        ("paragraph", "a long paragraph with many words, more than enough", 1, ""), ("note", "※ one, ① item", 2, "merged_note_continuation"), ("paragraph", "a: b c", 2, "merged_caption_continuation"),
        ("heading", "Short head 1", 1, "promoted_short_heading"), ("bullet", "- x", 1, ""), ("bullet", "- last one", 1, ""),
    ]
    assert got[2] == [] and got[3] is None and got[4] == []
    lines = F.array(*map(F.lit, ["a", "(’24 기준)", "b", "※ n", "(’23 x)", "c", "- d", " "]))
    assert [tuple(u) for u in spark.range(1).select(sections.structured_units(lines).alias("u")).first()["u"]] == [("a", 1), ("(’24 기준) b", 2), ("※ n (’23 x) c", 3), ("- d", 1)]


def test_pairs_against_a_loop(spark):
    rng = random.Random(1)
    data = [[rng.choice("abx") for _ in range(rng.randint(0, 12))] for _ in range(80)]
    df = spark.createDataFrame([(k, blocks(*(("p", t) for t in x))) for k, x in enumerate(data)], BLOCKS)
    made = sections.pairs_joined(F.col("b"), lambda a, b: (a["text"] != "x") & (b["text"] != "x"), lambda a, b: sections._block(a, "joined", text=F.concat(a["text"], b["text"])))
    for r in df.select("k", made.alias("c")).collect():
        rest, want = "".join(data[r["k"]]), []
        while rest:
            n = 2 if len(rest) > 1 and "x" not in rest[:2] else 1
            want, rest = [*want, rest[:n]], rest[n:]
        assert [b["text"] for b in r["c"]] == want


def test_sections_in_linear_time(spark):
    part = blocks(("paragraph", "some words of a longer line that stays"), ("bullet", "- x"), ("note", "※ y,"), ("paragraph", "① z"))
    small, large = (spark.createDataFrame([(1, part * n)], BLOCKS).cache() for n in (2_500, 20_000))
    small.count(), large.count()
    times = [seconds(lambda df=df: df.select(F.size(sections.cleaned(F.col("b")))).collect()) for df in (small, large)]
    assert times[1] < 16 * times[0] + 1
