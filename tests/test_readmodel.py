"""The queries of ``readmodel`` against their SQL, and its operators on written rows."""

import pytest
from pyspark.sql import functions as F

from docloom.operators import facets, mining, overview, pagetext, review
from docloom.plans import catalogue, readmodel_oracles
from tests.oracle import compare

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(readmodel_oracles.SQL))
def test_rows_equal_sql(spark, name):
    assert compare(spark, SF, catalogue.queries()[name], readmodel_oracles.SQL[name]) > 0


def test_policy_views(spark):
    rows = spark.createDataFrame([(1, "a", 1, True), (1, "a", 2, True), (2, "b", 3, False), (2, "c", 4, True), (3, "d", 5, False), (3, None, None, None)], "p int, g string, c int, ok boolean")
    got = {r[0]: tuple(r)[1:] for r in overview.policy_views(rows, "p", "g", "c", F.col("ok"), 1).collect()}
    assert got == {1: (1, 2, 1, 2, 0, "curated"), 2: (2, 2, 1, 1, 1, "mixed"), 3: (1, 1, 1, 0, 1, "provisional")}
    assert {r["n_visible"] for r in overview.policy_views(rows, "p", "g", "c", F.col("ok")).collect()} == {2, 1}
    assert overview.policy_views(rows.limit(0), "p", "g", "c", F.col("ok")).count() == 0


def test_bucket_without_match(spark):
    rows = spark.createDataFrame([(1, "a", 1, True), (1, "a", 2, None), (2, "b", 3, False)], "p int, g string, c int, ok boolean")
    got = {r[0]: tuple(r)[1:] for r in overview.bucket_signals(rows, F.col("ok"), ["p"], "g", "c").collect()}
    assert got == {1: (1, 2, 1, 1), 2: (1, 1, 0, 0)}


def test_selected_or_first(spark):
    rows = spark.createDataFrame([(1, 5, 2.0), (1, 6, 1.0), (2, 7, 1.0), (2, 8, 1.0), (3, 9, None)], "p int, k int, o double")
    wanted = spark.createDataFrame([(1, 5), (2, 99), (3, None), (4, 1)], "p int, k int")
    got = sorted(tuple(r) for r in overview.selected_or_first(rows, "p", wanted, "k", [F.col("o")]).collect())
    assert got == [(1, 5, True), (2, 7, False), (3, 9, False)]


def test_state_round_trip(spark):
    defaults = {"q": "", "view": "list", "tags": "all"}
    rows = [("", "list", "all"), ("a&b=c %", "grid", "x+y"), ("한글", None, "all"), (None, "list", "="), ("view=grid", "list", "&")]
    df = spark.createDataFrame(rows, "q string, view string, tags string")
    text = overview.state_text({c: F.col(c) for c in df.columns}, defaults)
    got = df.select("*", text.alias("s")).select("*", overview.state_fields(F.col("s"), defaults).alias("b")).collect()
    assert [r["s"] for r in got][0] == ""
    assert [(r["b"]["q"], r["b"]["view"], r["b"]["tags"]) for r in got] == [(q or "", v or "list", t) for q, v, t in rows]


def test_state_of_odd_texts(spark):
    defaults, allowed = {"view": "list", "n": "1"}, {"view": ["list", "grid"]}
    texts = ["view=grid&n=2", "view=bad", "n=&view=grid", "myview=grid", "view=grid&view=list", None, "n=%zz", "view"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(overview.state_fields(F.col("t"), defaults, allowed).alias("b")).collect()
    assert [(r["b"]["view"], r["b"]["n"]) for r in got] == [("grid", "2"), ("list", "1"), ("grid", "1"), ("list", "1"), ("grid", "1"), ("list", "1"), ("list", "1"), ("list", "1")]


def test_supporting_blocks(spark):
    """Against plain loops, with titles among the keywords, ties, short, null and empty texts."""
    words = ["solar", "wind", "water", "heat", "grid", ""]
    blocks = [(i % 7, i, " ".join(w for k, w in enumerate(words) if (i * 13 >> k) & 1) + "." * (i % 30)) for i in range(200)] + [(1, 900, None), (2, 901, ""), (None, 902, "solar" * 9)]
    titles = [(0, "solar"), (1, "wind"), (2, None), (3, "none")]
    want = set()
    for doc in {b[0] for b in blocks}:
        scored = []
        for d, i, t in blocks:
            held = {w for w in words if w and t and len(t) >= 20 and w in t} if d == doc else set()
            if held:
                scored.append((-(len(held) - (dict(titles).get(doc) in held)), i))
        want |= {(doc, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:2])}
    df = spark.createDataFrame(blocks, "doc_id int, block_id int, text string")
    got = overview.supporting_blocks(df, spark.createDataFrame([(w,) for w in words + words], "key string"), spark.createDataFrame(titles, "doc_id int, title string"))
    assert {tuple(r) for r in got.collect()} == want


def test_backlog_order(spark):
    rows = [("low", "a", 1, 1), ("odd", "a", 9, 2), ("high", "b", 1, 3), ("high", "a", 1, 5), ("high", "a", 2, 6), ("high", "a", 1, 4), ("none", "a", 1, 7)]
    df = spark.createDataFrame(rows, "p string, s string, n int, k int").orderBy(*overview.backlog_order(F.col("p"), F.col("s"), F.col("n"), F.col("k")))
    assert [r["k"] for r in df.collect()] == [6, 4, 5, 3, 1, 7, 2]


def test_grid_and_bounds(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "p string, seq long")
    assert [(r["p"], r["category"], r["number"]) for r in overview.catalogue_grid(df, "seq", ["a", "b"]).orderBy("number").collect()] == [("x", "a", 1), ("x", "b", 2), ("y", "a", 3), ("y", "b", 4)]
    rows = spark.createDataFrame([(1, 3), (1, None), (1, -2), (2, None)], "k int, v int")
    assert sorted(tuple(r) for r in overview.chunk_bounds(rows, ["k"], "v").collect()) == [(1, 3, -2, 3), (2, 1, 0, 0)]


def test_rebuilt_ledger(spark):
    a = spark.createDataFrame([("k1", "approved", "Kim"), ("k2", None, "Lee"), ("k2", None, "Lee")], "key string, status string, reviewer string")
    b = spark.createDataFrame([("k3", "rejected", 1), (None, "pending", 2)], "key string, status string, more int")
    drafts = spark.createDataFrame([("k1", "E1", 1), ("k1", "E2", 2), ("k9", "E3", 1)], "key string, exception string, seq int")
    got = sorted(map(repr, (tuple(r) for r in overview.rebuilt_ledger([a, b], drafts, "key", ["status", "reviewer"], ["exception", "note"]).collect())))
    assert got == sorted(map(repr, [("k1", "approved", "Kim", "E2", ""), ("k2", "", "Lee", "", ""), ("k2", "", "Lee", "", ""), ("k3", "rejected", "", "", ""), ("", "pending", "", "", "")]))


def test_statement_roles(spark):
    words = mining.RoleWords(
        change=("now:",), change_acts=("raise",), frame=("vision",), short_frame=("base",), case_pattern="^Case", background=("history",), hard_problem=("lack",), soft_problem=("weak",), need_pattern="needs? to", strong=("must",), acts=("support",)
    )
    want = {
        "now: 3, raise to 5": "regulatory_delta", "now: 3": "policy_action", "a vision of it": "meta_program_frame", "a base": "meta_program_frame", "a base " + "x" * 30: "policy_action", 'Case “A”': "case_example", "Case A": "policy_action",
        "☞ lack of it": "policy_action", "history of it": "background_context", "history, must go": "policy_action", "a lack": "problem_or_requirement", "weak links": "problem_or_requirement", "support weak links": "policy_action",
        "it needs to go": "problem_or_requirement", "it needs to support": "policy_action", "": "policy_action",
    }
    df = spark.createDataFrame([(t,) for t in [*want, None]], "t string").select("t", mining.statement_role(F.col("t"), words).alias("r")).collect()
    assert {r["t"]: r["r"]["role"] for r in df if r["t"] is not None} == want
    assert [tuple(r["r"]) for r in df if r["t"] is None] == [("policy_action", "")]


def test_surface_spacing(spark):
    cases = [("* * x", "note", "** x"), ("***x", "note", "*** x"), ("-x  y", "bullet", "- x y"), ("-x  y", "paragraph", "-x y"), ("| -x  a · b |", "table_markdown", "| -x  a · b |"), ("가 · 나", "paragraph", "가·나"), ("□x", "bullet", "□ x"), ("", "paragraph", ""), ("ab", "paragraph", "a b")]
    df = spark.createDataFrame([c[:2] for c in cases], "t string, k string").select(pagetext.spacing_fixed(F.col("t"), [("ab", "a b")], kind=F.col("k")).alias("x"))
    assert [r["x"] for r in df.collect()] == [c[2] for c in cases]


def test_rolled_up_nulls(spark):
    rows = [(1, 2, ["b", "a"], "y"), (1, 1, ["a", "c"], "x"), (1, 3, None, None), (2, 1, None, None)]
    got = sorted(tuple(r) for r in mining.rolled_up(spark.createDataFrame(rows, "g int, o int, m array<string>, t string"), ["g"], "o", ["m"], "t").collect())
    assert got == [(1, ["a", "c", "b"], "x y"), (2, [], "")]


def test_numbers_beyond_their_width(spark):
    """More keys than the width has digits for, most first seen together: gapless, in order, none cut short."""
    df = spark.range(3000).select((F.col("id") % 1500).alias("k"), F.floor(F.col("id") % 1500 / 700).alias("seq"))
    got = [r["id"] for r in facets.first_seen_ids(df, ["k"], "seq", "X", 2).orderBy("k").collect()]
    assert got == [f"X-{i + 1:02d}" for i in range(1500)]
    assert facets.first_seen_ids(df.limit(0), ["k"], "seq", "X", 2).count() == 0


def test_last_decision_counts(spark):
    rows = spark.createDataFrame([("1", "old"), ("2", "old")], "k string, v string")
    decided = spark.createDataFrame([("1", "z", 1), ("1", "a", 2)], "k string, v string, seq int")
    assert sorted(tuple(r) for r in review.overlaid(rows, decided, "k", ["v"], seq="seq").collect()) == [("1", "a"), ("2", "old")]
    assert sorted(tuple(r) for r in review.overlaid(rows, decided, "k", ["v"]).collect()) == [("1", "z"), ("2", "old")]


def test_supporting_blocks_keep_a_row_a_block(spark):
    """No row for each keyword of a block; repeated blocks, titles and keywords count once."""
    long = "alphabetagammadelta0"
    blocks = spark.createDataFrame([(1, 0, long), (1, 0, "x" + long), (1, 1, long + "epsilon"), (1, 2, long), (2, 0, "short"), (3, 0, long)], "doc_id long, block_id long, text string")
    words = spark.createDataFrame([("alpha",), ("alpha",), ("beta",), ("epsilon",), ("xalpha",), ("",), (None,)], "key string")
    titles = spark.createDataFrame([(1, "alpha"), (1, "alpha"), (3, None), (4, "beta")], "doc_id long, title string")
    got = overview.supporting_blocks(blocks, words, titles)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 0, 2), (1, 2, 1, 2), (3, 1, 0, 2)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan and "key#" not in plan.split("MapInArrow")[0]


def test_cells_count_one_kind_at_a_time(spark):
    """Against plain sets, with nulls everywhere; no row is laid out once for each kind of value."""
    data = [(p, d, g, c, e, r, s) for k, (p, d, g, c) in enumerate((p, d, g, c) for p in ("x", None) for d in ("a", None, "unmapped") for g in (1, 2, None) for c in (10, 11, None)) for e, r, s in [(k % 3 or None, [True, False, None][k % 3], "uvw"[k % 2])] if k % 5]
    df = spark.createDataFrame(data, "p string, d string, g int, c int, e int, r boolean, s string")
    cells = {}
    for row in data:
        cells.setdefault((row[0], row[1] or "unmapped"), []).append(row)
    size = lambda rows, at, keep=lambda r: True: len({r[at] for r in rows if keep(r)} - {None})
    want = {k: (size(v, 2), size(v, 3), sum(r[4] or 0 for r in v)) for k, v in cells.items()}
    found = facets.matrix(df, "p", "d", "g", "c", "e")
    assert {(r["policy"], r["domain"]): (r["n_groups"], r["n_contents"], r["n_evidence"]) for r in found.collect()} == want
    detail = facets.matrix_detail(df.filter("p is not null"), "p", "d", "g", "c", "r", "s")
    assert {(r["policy"], r["domain"]): (r["n_groups"], r["n_contents"], r["n_reviewed"]) for r in detail.collect()} == {k: (size(v, 2), size(v, 3), size(v, 3, lambda r: r[5])) for k, v in cells.items() if k[0]}
    assert not any("Expand" in x._jdf.queryExecution().optimizedPlan().toString() for x in (found, detail))
