"""The operators behind the evidence queries on small fixtures and odd rows, and the queries without SQL."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from docloom.operators import align, facets, fields, graph, labels, lens, mining, pagetext, review, scoring, tables, textops, validate
from docloom.plans import evidence, evidence_oracles
from docloom.sources import files, sinks
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
NO_SQL = {"q11_continuation_merge", "q15_span_alignment", "q25_merge_draft", "q54_ocr_noise_cluster", "q61_provisional_fill", "q62_domain_rollup_maps", "q72_column_rules", "q93_manifest_files"}


def one(spark, *columns):
    """The values of expressions over a single row."""
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("name", sorted(evidence_oracles.SQL))
def test_rows_equal_sql(spark, name):
    compare(spark, SF, getattr(evidence, name), evidence_oracles.SQL[name])


def test_queries_without_sql(spark):
    every = {n for n in vars(evidence) if n[0] == "q" and n[1:3].isdigit()}
    assert every - set(evidence_oracles.SQL) == NO_SQL
    maps = evidence.q15_span_alignment(spark, SF)
    assert maps.filter("n_mapped <> n_paragraphs").count() == 0
    assert evidence.q62_domain_rollup_maps(spark, SF).filter("n_contents < n_groups or n_primary > n_groups").count() == 0
    filled = evidence.q61_provisional_fill(spark, SF)
    assert filled.count() == filled.select("group_id").distinct().count() > 0
    assert evidence.q93_manifest_files(spark, SF).count() == 2 and evidence.q54_ocr_noise_cluster(spark, SF).count() > 0
    lines = evidence.q11_continuation_merge(spark, SF).groupBy("doc_id").agg(F.sum("merged").alias("n"))
    want = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.size(F.filter(F.split("text", "\n"), lambda x: x != "")).alias("m")).filter("m > 0")
    assert lines.join(want, "doc_id").filter("n <> m").count() == 0 and lines.count() == want.count()
    assert evidence.q25_merge_draft(spark, SF).filter("group_no < 1 or page is null").count() == 0


# fields and labels


def test_fields(spark):
    null = F.lit(None).cast("string")
    assert one(spark, fields.first_filled(null, F.lit(""), F.lit("b"), F.lit("c")), fields.first_filled(null)) == ("b", "")
    assert one(spark, fields.by_rules([(F.lit(None).cast("boolean"), "x"), (F.lit(True), "y")], "z"), fields.looked_up(F.lit("q"), {"p": 1}, 9)) == ("y", 9)
    assert [fields.valid_choice(v, ["a"]) for v in ("a", "b", None)] == ["a", "all", "all"]
    assert one(spark, fields.mapping_state(F.array(), "unmapped"), fields.mapping_state(F.expr("cast(null as array<string>)"), "mapped"), fields.mapping_state(F.array(), "odd")) == (True, False, True)
    assert one(spark, *(fields.number_key(F.lit(x)) for x in ("12", "x", "")), fields.number_key(null)) == (12, 10**9, 10**9, 10**9)
    assert one(spark, *(fields.preview_kind(F.lit(x)) for x in ("a/b.PNG", "z.zip::in.pdf", "x.pdf?d=1", "", "noext"))) == ("image", "unsupported", "pdf", "none", "unsupported")
    assets = F.expr("array(named_struct('n', 1, 'previewable', false, 'is_figure', true), named_struct('n', 2, 'previewable', true, 'is_figure', false))")
    assert one(spark, fields.preferred_asset(assets)["n"], fields.preferred_asset(F.slice(assets, 1, 1))["n"]) == (2, 1)
    assert one(spark, fields.has_override(null), fields.has_override(F.lit("pending"), F.lit(" ")), fields.has_override(F.lit("done")), fields.has_override(F.lit(""), F.lit("x"))) == (False, False, True, True)
    assert fields.limited(spark.range(20), 9_999).count() == 20 and fields.limited(spark.range(20), 12).count() == 12
    assert one(spark, fields.shown_date(F.lit("2024-02-03")), fields.shown_date(F.lit("soon"))) == ("2024.02.03", "soon")
    assert fields.selected(spark.range(5), {"id": []}).count() == 5 and fields.selected(spark.range(5), {"id": [1, 9]}).count() == 1


def test_labels(spark):
    assert one(spark, labels.label(F.lit("- The plan (Big Idea) is"))) == ("Big Idea",) and one(spark, labels.label(F.lit("• one, two"))) == ("one",)
    assert one(spark, labels.label(F.lit("x" * 50)), labels.label(F.lit("x" * 61), 60, 57, retry=False)) == ("x" * 45 + "...", "x" * 57 + "...")
    assert one(spark, labels.summary(F.lit("y " * 120), "proxy"))[0].endswith("y…")
    assert one(spark, labels.slug(F.lit("  A--b 가/나! ")), labels.slug(F.lit("!!")), labels.slug(F.lit(None))) == ("a-b-가-나", "item", "item")
    assert one(spark, labels.compare_key(F.lit("•​ a –ﬁ")), labels.without_private_use(F.lit("ab"))) == ("-a-fi", "a-b")
    assert one(spark, textops.match_key(F.lit("Ａ ｂ")), textops.match_key(F.lit("é"))) == ("ab", "é")
    assert one(spark, labels.label_tokens(F.lit("AI·데이터 (x)/전략"), ["전략"])) == (["ai", "데이터"],)
    assert one(spark, labels.keywords(F.array(F.lit("b-a aa"), F.lit("aa cc")))) == (["aa", "cc"],)
    assert one(spark, *(labels.topic_particle(F.lit(x)) for x in ("가", "각", "a", ""))) == ("는", "은", "는", "는") and one(spark, labels.object_particle(F.lit("물"))) == ("을",)
    assert one(spark, *(labels.location(F.lit(x)) for x in ("3", "section1", "Section 3", "section9", "page 7", "page", "", "annex", "section"))) == ("3쪽", "문서 앞부분", "문서 중간", "문서 후반부", "7쪽", "페이지", "위치 정보 확인", "annex", "문서 위치")
    assert one(spark, labels.without_lead(F.lit("- ○ ➊①x")), labels.looks_raw(F.lit("(a")), labels.looks_raw(F.lit("z" * 50)), labels.looks_raw(F.lit("a b"))) == ("x", True, True, False)
    assert one(spark, labels.html_escaped(F.lit("<a b='c'>&\"")), labels.spaced(F.lit("가A나다")), labels.is_generic_caption(F.lit("Image 3")), labels.is_generic_caption(F.lit("Cost"))) == ("&lt;a b=&#x27;c&#x27;&gt;&amp;&quot;", "가 A 나다", True, False)


def test_scores(spark):
    term = scoring.Term("AI 데이터 전략 플랫폼", ("ml", "ㄱ", ""), ("plan", ""), "D1")
    k = scoring.plain_key

    def points(text, **how):
        row = {n: F.lit(k(v)) if n != "prior" else F.lit(v) for n, v in how.items() if n not in ("title_only", "generic")}
        return one(spark, scoring.points(term, F.lit(k(text)), **row, **{n: v for n, v in how.items() if n in ("title_only", "generic")}))[0]

    assert points("ＡＩ 데이터 전략 플랫폼") == 8 + 6  # at most three of the label's words count
    assert points("데이터", generic=frozenset({"데이터"})) == 0 and points("") == 0
    assert points("uses ML", focus="ml") == 4 and points("ㄱ", focus="ㄱ") == 3 and points("x", focus="ml") == 0
    assert points("x", title="Plan B") == 4 and points("the plan", title="x") == 4 and points("the plan", title="x", title_only=True) == 0
    assert points("x", prior="D1") == 4 and points("x", prior=None) == 0
    terms = F.expr("array_sort(array(named_struct('minus', -12, 'o', 1), named_struct('minus', -11, 'o', 2), named_struct('minus', -9, 'o', 3)))")
    assert one(spark, F.size(scoring.within_margin(terms)), F.size(scoring.within_margin(F.slice(terms, 3, 1))), F.size(scoring.within_margin(F.slice(terms, 1, 0)))) == (2, 1, 0)
    assert one(spark, *(scoring.confidence(F.lit(n), scoring.PARAGRAPH_STEPS, None) for n in (3, 4, 6, 10))) == (None, "low", "medium", "high")
    name = lambda t: scoring.unique_max(F.lit(t), {"a": ("x",), "b": ("y",)})[0]
    assert one(spark, name("x"), name("xy"), name("z")) == ("a", None, None)


# page text, alignment, tables


def test_page_text(spark):
    kinds = {"| a | b |": "table_markdown", "# T": "heading", "① x": "heading", "Ⅱ. x": "heading", "2) x": "heading", "(’24 기준)": "citation", "※ n": "note", "** n": "note", "- b": "bullet", "ㅇ b": "bullet", "plain": "paragraph"}
    assert one(spark, *(pagetext.unit_type(F.lit(t)) for t in kinds)) == tuple(kinds.values())
    assert one(spark, pagetext.unit_type(F.lit("short"), F.lit(True)), pagetext.unit_type(F.lit("①x and more text"), F.lit(False))) == ("heading", "paragraph")
    assert one(spark, pagetext.joined(F.lit("a ("), F.lit("b")), pagetext.joined(F.lit("a"), F.lit(", b")), pagetext.joined(F.lit(""), F.lit("b"))) == ("a (b", "a, b", "b")
    lines = F.array(*map(F.lit, ["- one", "two", "# three", "four"]))
    assert one(spark, pagetext.units(lines), pagetext.units(F.slice(lines, 1, 0))) == (["- one two", "# three four"], None)
    assert one(spark, pagetext.split_sections(F.lit("a ① (b) c ② (d)"))) == (["a", "① (b) c", "② (d)"],)
    assert one(spark, pagetext.without_short_runs(F.array(*map(F.lit, ["long enough text", "a", "b", "c", "another long text", "d"])))) == (["long enough text", "another long text", "d"],)
    assert one(spark, pagetext.titles_merged(F.array(*map(F.lit, ["Ⅰ.", "Title", "x"])))) == (["Ⅰ. Title", "x"],)
    marks = F.array(*map(F.lit, ["cover", "x", "tel"]))
    assert one(spark, pagetext.trimmed_blocks(marks, lambda x: x == "cover", lambda x: x == "tel")) == (["x"],)
    reasons = [(" ", 0, 0.0), ("• *", 0, 0.0), ("- 3 -", 0, 0.0), ("p 3", 950, 0.0), ("text", 0, 0.4), ("text", 0, 0.1)]
    assert one(spark, *(pagetext.skip_reason(F.lit(t), F.lit(y), F.lit(1000), F.lit(c)) for t, y, c in reasons)) == ("empty", "noise", "footer", "footer", "table_overlap", None)
    assert one(spark, pagetext.spacing_fixed(F.lit("·a · b ab"), [("ab", "a b")], [("b", "c")])) == ("·a·c a c",)
    df = spark.createDataFrame([(1, "| a | b |\n| 1 | 2 |\ntext\nmore\n\nlast"), (2, None), (3, "")], "doc_id long, text string")
    got = [(r["doc_id"], r["kind"], r["text"]) for r in pagetext.markdown_blocks(df, "doc_id", "text").orderBy("doc_id", "pos").collect()]
    assert got == [(1, "table", "| a | b |\n| 1 | 2 |"), (1, "text", "text\nmore"), (1, "text", "last")]


def test_alignment():
    keys = ["head", "aa", "bb", "cc", "long line here", "zz", "", "yy"]
    assert align.align([("aa", 1), ("bbcc", 2), ("line", 1), ("head", 1), ("none", 1), ("", 1)], keys) == [
        (1, 2, "exact_match"), (2, 4, "exact_match"), (4, 5, "fuzzy_single_block"), (0, 1, "exact_match_page_fallback"), None, None,
    ]
    assert align.align([("aabbcc", 1)], keys, is_page=False) == [(1, 4, "exact_variable_span")] and align.align([("a", 1)], []) == [None]


def test_tables(spark):
    noise = [("", 0.9), ("abc", 0.8), ("abc", 0.9), ("a good text", 0.64), ("--==--==a", 0.8), ("a good text", 0.7), ("※※※※※", 0.95)]
    assert one(spark, *(tables.is_noise(F.lit(t), F.lit(s)) for t, s in noise)) == (True, True, False, True, True, False, True)
    cells = F.array(F.array(F.lit(""), F.lit(None)), F.array(F.lit(" a "), F.lit("b")))
    assert one(spark, tables.preview(cells), tables.preview(F.expr("cast(array() as array<array<string>>)"))) == ("a | b", "")
    kind = lambda r, c, p, f="hwpx", fl=False: tables.table_class(F.lit(r), F.lit(c), F.lit(p), F.lit(f), F.lit(fl), ["담당 부서"])["reason"]
    got = one(spark, kind(3, 3, ""), kind(5, 5, "담당부서"), kind(1, 1, "x"), kind(1, 3, "x"), kind(2, 2, "<비전>"), kind(5, 5, "x", fl=True), kind(3, 4, "x"), kind(4, 2, "20 %"), kind(3, 1, "x"), kind(3, 2, "x"), kind(2, 5, "x"), kind(1, 2, "x", "pdf"), kind(2, 9, "x", "pdf"), kind(4, 2, "상반기", "pdf"), kind(3, 2, "x", "pdf"), kind(2, 4, "x", "pdf"))
    assert got == ("empty_table_box", "front_matter_table", "single_cell_layout_box", "single_row_layout_box", "heading_box", "floating_layout_box", "hwpx_matrix_table", "hwpx_grid_table", "single_column_info_box", "hwpx_needs_manual_review", "small_hwpx_layout_box", "single_row_small_box", "wide_text_fragment", "timeline_fragment", "shape_based", "needs_manual_review")
    shape = one(spark, tables.markdown_shape(F.lit("| a | b |\n|--|--|\n| 1 | 2 |")), tables.markdown_shape(F.lit("a")), tables.markdown_shape(F.lit(None)))
    assert [tuple(s) for s in shape] == [(2, 2, "| a | b |"), (0, 0, "a"), (0, 0, "")]
    raw, done = (spark.createDataFrame(r, "doc_id int, x string") for r in ([(1, "a"), (1, "b"), (2, "c")], [(1, "r")]))
    assert sorted(tuple(r) for r in tables.reviewed_first(raw, done).collect()) == [(1, "r"), (2, "c")]
    queue = spark.createDataFrame([(1, "a", "structured_table"), (1, "b", "structured_table"), (1, "c", "layout_false_positive")], "doc_id int, t string, table_class string")
    assert sorted((r["t"], r["decision"], r["canonical_id"]) for r in tables.seeded_decisions(queue, "t").collect()) == [("a", "accepted", "TBL-1-001"), ("b", "accepted", "TBL-1-002"), ("c", "rejected", None)]


# mining, projection, review


def test_merge_draft(spark):
    row = lambda page, candidate, skip="", kind="paragraph", chars=50, marked=False: {"page": page, "candidate": candidate, "skip": skip, "block_type": kind, "chars": chars, "marked": marked}
    rows = [row(1, "yes", kind="bullet"), row(1, "yes"), row(1, "review", kind="note"), row(1, "review", kind="paragraph"), row(1, "yes", "no_action_no_taxonomy"), row(2, "no"), row(2, "yes"), row(2, "yes", kind="bullet")]
    assert mining.grouped_rows(rows) == [(1, "primary"), (1, "continuation"), (1, "review"), (None, ""), (None, ""), (None, ""), (2, "primary"), (3, "primary")]
    df = spark.createDataFrame([(1, i, r["page"], r["candidate"], r["skip"] or None, r["block_type"], f"t{i}") for i, r in enumerate(rows)], "doc_id long, pos long, page long, candidate string, skip string, block_type string, text string")
    got = sorted(tuple(r) for r in mining.merge_draft(df).collect())
    assert got == [(1, 1, 1, "t0 t1", 1, 1, "medium"), (1, 2, 2, "t6", 0, 0, "low"), (1, 3, 2, "t7", 0, 0, "medium")]
    assert mining.merge_draft(df.limit(0)).count() == 0


@pytest.mark.parametrize("query", [evidence.q15_span_alignment, evidence.q25_merge_draft])
def test_documents_go_to_python_in_batches(spark, query):
    """No call of Python a document: thousands of small ones took milliseconds each."""
    plan = query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "GroupsInPandas" not in plan and "GroupsInArrow" not in plan


@pytest.mark.parametrize("query", [evidence.q24_candidate_mine_dedupe, evidence.q60_skip_reasons, evidence.q25_merge_draft])
def test_texts_are_cleaned_once(spark, query):
    """White space is collapsed once a line, not in each rule that reads the line."""
    plan = query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count(r"(?U)\s+") <= 4


def test_merge_draft_of_named_pages(spark):
    """Pages may be texts, and null fields hold nothing back."""
    data = [(1, 0, "a", "yes", None, "paragraph", "x"), (1, 1, "a", "yes", None, "paragraph", None), (1, 2, "b", "yes", None, None, "y"), (1, 3, None, "yes", None, "bullet", "z"), (1, 4, None, None, None, "note", "w"), (2, 0, "a", "no", None, "note", "v")]
    df = spark.createDataFrame(data, "doc_id long, pos long, page string, candidate string, skip string, block_type string, text string")
    got = [tuple(r) for r in mining.merge_draft(df).orderBy("doc_id", "group_no").select("doc_id", "group_no", "page", "n_continuations", "confidence").collect()]
    assert got == [(1, 1, "a", 1, "medium"), (1, 2, "b", 0, "low"), (1, 3, None, 0, "medium")]


def test_source_map_of_pages_without_lines(spark):
    paragraphs = spark.createDataFrame([(1, 1, 1, "cc", 1), (1, 1, 0, "aabb", 2), (1, 2, 0, "aa", 1), (2, 1, 0, None, 1)], "doc_id long, page_no long, pos long, key string, merged long")
    lines = spark.createDataFrame([(1, 1, 2, "cc"), (1, 1, 0, "aa"), (1, 1, 1, "bb"), (2, 1, 0, None), (3, 1, 0, "zz")], "doc_id long, page_no long, line_order long, key string")
    got = sorted(tuple(r) for r in align.source_map(paragraphs, lines).collect())
    assert got == [(1, 1, 0, 0, 2, "exact_match"), (1, 1, 1, 2, 3, "exact_match"), (1, 2, 0, None, None, "unmapped"), (2, 1, 0, None, None, "unmapped")]
    assert align.source_map(paragraphs.limit(0), lines).count() == 0


def test_draft_pack_links_without_a_join(spark):
    groups = spark.createDataFrame([(1, [7, 8], ["a", "b"]), (2, [], ["c"]), (None, [9], ["d"]), (3, [5], None)], "g long, items array<int>, contents array<string>")
    links = lens.draft_pack(groups, "g", "items", "contents")["links"]
    assert sorted(tuple(r) for r in links.select("g", "content_id", "item").collect()) == [(1, "1-C01", 7), (1, "1-C01", 8), (1, "1-C02", 7), (1, "1-C02", 8)]
    assert "Join" not in links._jdf.queryExecution().optimizedPlan().toString()


def test_lens(spark):
    terms = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (2, "a", 1), (2, "b", 1), (3, "a", None)], "item int, term string, is_primary int")
    got = sorted(tuple(r) for r in lens.assigned(spark.range(1, 5).withColumnRenamed("id", "item"), terms, "item", "term").collect())
    assert got == [(1, "a", "assigned"), (2, None, "ambiguous"), (3, None, "unassigned"), (4, None, "unassigned")]
    items = spark.createDataFrame([("d1", 1, "p", 5), ("d1", 2, "p", 4), ("d1", 3, "q", 3), ("d2", 4, "p", 1), ("d3", 5, "p", 1)], "domain string, item int, pair string, rank int")
    have = spark.createDataFrame([("d1", 1, 1, 7), ("d2", 2, 0, 2)], "domain string, n_groups int, n_auto int, last_order int")
    got = [(r["item"], r["display_order"]) for r in lens.provisional_fill(items, have, "domain", ["pair"], F.struct("rank", "item"), 3).orderBy("item").collect()]
    assert got == [(2, 9), (3, 8), (5, 1)]  # one place is taken, so two are left: the best of each pair; d2 is complete
    assert one(spark, *(lens.curation_stage(F.lit(n), F.lit(c)) for n, c in ((0, 0), (2, 0), (9, 2), (9, 6)))) == ("empty", "seed", "expand", "covered")


def test_review(spark):
    rows = spark.createDataFrame([("L", None, ["b", "a"], "keep"), ("F", "L", ["a", "c"], "keep"), ("G", "gone", ["x"], None), ("D", None, ["q"], "drop"), ("H", "D", ["q"], "keep"), ("E", None, [], "keep")], "item string, into string, evidence array<string>, decision string")
    leads, issues = review.merged_items(rows)
    assert sorted((r["leader"], r["evidence"]) for r in leads.collect()) == [("E", []), ("L", ["b", "a", "c"])]
    assert sorted(tuple(r) for r in issues.collect()) == [("E", "no_evidence"), ("G", "missing_leader"), ("H", "dropped_leader")]
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1)], "k int, v string, s int")
    assert sorted(tuple(r) for r in review.upsert(base, twice, "k", "s").collect()) == [(1, "y"), (2, "z")]
    assert one(spark, review.lens_key(F.lit("d"), F.lit("p"), F.lit(None), F.lit("b, a | b"))) == one(spark, review.lens_key(F.lit("d"), F.lit("p"), F.lit(""), F.lit("a|b")))
    over = review.overlaid(spark.createDataFrame([(1, "f", "old"), (2, "g", "old"), (3, "h", None)], "k int, alt string, v string").withColumn("k", F.col("k").cast("string")), spark.createDataFrame([("1", "n1"), ("g", "n2"), ("g", "n0")], "k string, v string"), "k", ["v"], "alt")
    assert sorted((r["k"], r["v"]) for r in over.collect()) == [("1", "n1"), ("2", "n2"), ("3", None)]
    assert one(spark, review.exception_ids(F.lit("a | b"), F.lit("x"), ["x"]), review.exception_ids(F.lit(None), F.lit("see EX-2"), ["EX-1", "EX-2"])) == (["a", "b"], ["EX-2"])
    queue = spark.createDataFrame([(1, 5), (2, 9)], "k int, n int")
    old = spark.createDataFrame([(2, "pending", ""), (3, "pending", ""), (4, "pending", "note"), (5, "approved", None)], "k int, status string, note string")
    kept = review.lens_synced(queue, old, "k", F.col("status").isin("approved"), "note")
    assert sorted((r["k"], r["active"]) for r in kept.collect()) == [(1, True), (2, True), (4, False), (5, False)]


# facets, graph, validation


def test_graph_and_checks(spark):
    assert one(spark, graph.literal(F.lit('a"b\\c\nd')), graph.iri("b", "k", F.lit("a/b ~é*"))) == ('"a\\"b\\\\c\\nd"', "b/resource/k/a/b%20~%C3%A9%2A")
    facts = spark.createDataFrame([("http://s", "p", "x"), ("http://s", "p", "x"), ("http://s", "p", "http://o"), ("http://s", "a", "1")], "subject string, predicate string, object string")
    assert graph.turtle(facts, "e").first()["block"] == '<http://s>\n  e:a "1" ;\n  e:p "x", <http://o> .'
    assert graph.datatype_violations(facts, "p", "^http").count() == 2
    none = spark.createDataFrame([], "k int, v int")
    assert [tuple(r) for r in validate.findings(none, [("error", "e", F.col("v") > 0)]).collect()] == [("error", "e", 0)]
    assert validate.coverage(none, F.lit(True), 0.9, "warning", "c").first()["ratio"] == 0.0
    assert [tuple(r) for r in validate.row_errors(spark.createDataFrame([(1, None), (2, 5)], "k int, v int"), "k", {"v": F.col("v") > 3}).collect()] == [(1, "v")]
    dims = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    assert sorted(tuple(r) for r in facets.options(dims, spark.createDataFrame([("a", 2)], "v string, n int"), "v", "c").collect()) == [("a", 2, False), ("c", 0, True)]


# files and sinks


def office(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def test_office_files(spark):
    docx = office(**{"word/document.xml": '<w:document xmlns:w="w"><w:body><w:p><w:r><w:t>He</w:t></w:r><w:r><w:t>llo</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:t>a</w:t></w:p></w:tc><w:tc/></w:tr><w:tr><w:tc><w:t>b</w:t></w:tc></w:tr></w:tbl></w:body></w:document>'})
    hwpx = office(**{"Contents/section0.xml": '<s xmlns:h="h"><h:p><h:t>own</h:t><h:tbl><h:tr><h:tc><h:p><h:t>c</h:t></h:p></h:tc></h:tr></h:tbl><h:rect><h:p><h:t>shape</h:t></h:p></h:rect><h:pic><h:img binaryItemIDRef="i1"/></h:pic></h:p></s>'})
    xlsx = office(**{"xl/sharedStrings.xml": "<sst><si><t>dom</t></si><si><t>sub</t></si></sst>", "xl/worksheets/sheet1.xml": '<w><sheetData><row r="1"><c r="A1"><v>7</v></c></row><row r="3"><c r="A3" t="s"><v>0</v></c><c r="C3" t="s"><v>1</v></c></row></sheetData><mergeCells><mergeCell ref="A1:B1"/></mergeCells></w>'})
    df = spark.createDataFrame([("d", docx), ("h", hwpx), ("x", xlsx), ("bad", b"no archive"), ("none", None)], "path string, content binary")
    assert [(r["path"], r["pos"], r["kind"], r["text"], r["cells"]) for r in files.docx_blocks(df).orderBy("pos").collect()] == [("d", 1, "paragraph", "Hello", None), ("d", 2, "table", None, [["a", ""], ["b", ""]])]
    assert [(r["kind"], r["text"]) for r in files.hwpx_blocks(df.filter("path = 'h'")).orderBy("pos").collect()] == [("paragraph", "own"), ("table", None), ("shape_text", "shape"), ("picture", "i1")]
    rows = files.xlsx_rows(df).filter("path = 'x'")
    assert [(r["row"], r["cells"], r["merged"]) for r in rows.orderBy("row").collect()] == [(1, ["7", "", ""], ["A1:B1"]), (2, ["", "", ""], ["A1:B1"]), (3, ["dom", "", "sub"], ["A1:B1"])]
    assert [tuple(r)[:2] for r in files.unpivoted(rows).collect()] == [("dom", "sub")]
    nested = office(**{"in.zip": office(**{"f.txt": "deep"})})
    assert files.zip_member(nested, "in.zip::f.txt") == b"deep"
    assert [(r["member"], r["content"]) for r in files.zip_members(spark.createDataFrame([("z", office(**{"a/": "", "a/b": "1"}))], "path string, content binary")).collect()] == [("a/b", bytearray(b"1"))]


def test_text_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿id,text\r\n1,"x ""q"", y\nz"\r\n,\r\n2\r\n'.encode())
    assert [tuple(r) for r in files.csv_rows(spark, f"{tmp_path}/a.csv", ["id", "text"]).collect()] == [("1", 'x "q", y\nz'), ("2", "")]
    assert files.csv_rows(spark, f"{tmp_path}/none.csv", ["id"]).count() == 0 and files.json_rows(spark, f"{tmp_path}/none.json", "n int").count() == 0
    (tmp_path / "l.json").write_text('[{"n": 1}, {"n": 2}]')
    (tmp_path / "o.json").write_text('{"blocks": [{"n": 3}]}')
    assert sorted(r["n"] for r in files.json_rows(spark, f"{tmp_path}/*.json", "n int").collect()) == [1, 2, 3]
    for k in (1, 2):
        (tmp_path / f"DOC-{k}__paragraphs.csv").write_text(f"t\nx{k}\n")
    known = spark.createDataFrame([("DOC-2",)], "doc string")
    assert [tuple(r) for r in files.named_rows(spark, f"{tmp_path}/DOC-*__paragraphs.csv", ["t"], r"^(.+)__", "doc", known).collect()] == [("DOC-2", "x2")]
    with pytest.raises(FileNotFoundError):
        sinks.manifest(spark, [f"{tmp_path}/missing"])
    sinks.write_json(spark.createDataFrame([(1, None)], "a int, b string"), f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first()[0] == '{"a":1,"b":null}'


def test_stored_tables(spark, tmp_path):
    base = spark.createDataFrame([(1, "u1", 0), (2, "u2", 0), (3, None, 0)], "k int, u string, v int")
    fresh = spark.createDataFrame([(1, "u2", 1, 1), (1, "u9", 2, 2), (4, None, 3, 1)], "k int, u string, v int, seq int")
    assert sorted(((r["k"], r["v"]) for r in sinks.replaced(base, fresh, [["k"], ["u"]], "seq").collect())) == [(1, 2), (3, 0), (4, 3)]  # (2, u2) went when (1, u2) was put in, as in SQLite
    doomed = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        sinks.cascade({"b": (base, "k")}, doomed, "k", doomed)
    left, counts = sinks.cascade({"b": (base, "k")}, doomed, "k", doomed.limit(0))
    assert left["b"].count() == 2 and counts.first()["n"] == 1
    with pytest.raises(FileNotFoundError):
        sinks.load_pack(spark, str(tmp_path), [("t", ["k"])], {})
    assert sinks.slice_replaced(base, F.col("u") == "u1", base.limit(0)).count() == 2  # a null doesn't make a row part of the slice
