"""Rules, layout, links, sources and sinks, on small fixtures and against plain Python."""

import json
import re

import pytest
from pyspark.sql import functions as F

from quire.functions import formulas as X
from quire.functions import text as T
from quire.operators import concepts, graph, layout, links, tables
from quire.sources import layout_json, sinks
from quire.streaming.ingest import stream_layouts, windowed_counts


def one(spark, column, *values, schema="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_text_cleaning(spark):
    assert one(spark, T.normalize_spaces, " a­ b\t\nc ", None) == ["a b c", ""]
    assert one(spark, T.collapse_spaced_capitals, "C H A P T E R 1", "A B", "x A B C y D E F", "É A B C") == ["CHAPTER 1", "A B", "x ABC y DEF", "É ABC"]
    assert one(spark, T.roman_to_int, "xiv", "IX", "no", None) == [14, 9, None, None]
    assert one(spark, T.heading_level, "Chapter 3", "3.1.2 x", "Section 2", "Key Terms", "4 x") == [1, 3, 2, 2, 1]
    assert one(spark, T.page_list, "1-3, 7; 9", None, "x, 2", "5-3") == [[1, 2, 3, 7, 9], [], [2], [3, 4, 5]]
    assert one(spark, T.chapter_main, "Chapter 7 > 7.1 x", "7.1 x", "x > 8 y", "none") == ["7", "7", "8", None]


def test_labels(spark):
    got = one(spark, lambda c: T.text_object(c), "Note: x", "Solution to 3", "Example 2.1 a", "We derive r = 3", "We derive it", "Find x", "1. Do it", "- a", "Term: b", "plain", "", None, "given: x", "given:x")
    assert got == ["note", "solution_candidate", "worked_example_candidate", "derivation_candidate", "text", "calculation_candidate", "procedure", "list", "definition", "text", "text", "text", "definition", "worked_example_candidate"]
    assert one(spark, T.title_object, "Concept Check Solutions", "Problem Sets", "Glossary", "Other", None) == ["concept_check_solution", "problem_sets", "key_terms", "", ""]
    assert one(spark, lambda c: T.numbering(c)["normalized"], "Question 3.2) x", "(4) y", "Concept Check 5", "2024 was", "no", None) == ["3.2", "4", "5", "2024", None, None]
    assert one(spark, T.cross_references, "see Figure 1.2 and Fig. 1.2, Table 3; Eq. (4.1) Appendix B", None) == [[("figure", "1.2"), ("table", "3"), ("equation", "4.1"), ("appendix", "B")], []]
    assert one(spark, T.is_list_continuation, "and more", "lower", "Upper", "- item", "") == [True, True, False, False, False]


@pytest.mark.parametrize("value, kind", [
    ("$1,200", "currency"), ("12%", "percent"), ("1,234.5", "number"), ("-30", "text"), (".25", "text"), ("=SUM(A1)", "formula"), ("3/4/2024", "date"), ("", "blank"), (None, "blank"), ("A=B", "formula"),
    ("5 percent", "percent"), ("USD 5", "currency"), ("DIFF-1", "formula"),
])
def test_cell_types(spark, value, kind):
    assert one(spark, X.cell_type, value) == [kind]


def test_formulas(spark):
    assert one(spark, X.equation_number, "a = b (3.1)", "Eq. 4 says", r"x \tag{5}", "none") == ["(3.1)", "(4)", "(5)", None]
    assert one(spark, X.symbols, "r = a + beta * r", None) == [["a", "beta", "r"], []]
    assert one(spark, lambda c: X.cell_address(c, F.lit(27)), 0, schema="int") == ["AB1"]


BLOCKS = "doc_id long, ord long, page_idx long, x0 double, y0 double, x1 double, y1 double, block_type string, text string"


def blocks(spark, *rows):
    return spark.createDataFrame([(1, i, p, 0.0, float(y), 10.0, float(y) + 5, k, t) for i, (p, y, k, t) in enumerate(rows)], BLOCKS)


def test_outline_and_groups(spark):
    b = blocks(spark, (0, 0, "heading", "Chapter 1"), (0, 10, "heading", "1.1 A"), (0, 20, "text", "- one"), (0, 30, "text", "and so"), (0, 40, "text", "Plain"), (1, 0, "heading", "Chapter 2"), (1, 10, "text", "x-"), (1, 20, "text", "ray"))
    paths = {r.ord: r.heading_path for r in layout.outline(b).collect()}
    assert paths[1] == paths[4] == "Chapter 1 > 1.1 A" and paths[6] == "Chapter 2"
    assert [(r.start_idx, r.end_idx) for r in layout.sections(b).orderBy("start_idx").collect()] == [(0, 0), (1, 4), (5, 7)]
    assert [r.content for r in layout.list_groups(b).collect()] == ["- one\nand so"]
    assert {r.head_ord: r.content for r in layout.title_groups(b).collect()}[5] == "Chapter 2\nx-\nray"
    assert [r.text for r in layout.stitch(b).orderBy("ord").collect()][-1] == "xray"
    assert layout.outline(b.limit(0)).count() == 0


def test_links(spark):
    b = blocks(spark, (0, 0, "table", "Table 1.1 a"), (0, 10, "table", "Table 1.1 b"), (0, 20, "text", "see Table 1.1 and Table 9"))
    got = {(r.id, r.target_ord) for r in links.linked_references(b.where("block_type = 'text'"), links.reference_index(b.where("block_type = 'table'"))).collect()}
    assert got == {("1.1", 1), ("9", None)}
    q = spark.createDataFrame([(1, 1, 1, "c", "z", "3", ["a"]), (1, 5, 2, "c", "z", "3", ["a"]), (1, 7, 2, "c", "z", "4", ["b"])], "doc_id long, ord long, page_idx long, chapter string, zone string, num string, words array<string>")
    s = spark.createDataFrame([(1, 10, 2, "c", "z", "3", ["a"]), (1, 11, 2, "c", "z", "3", ["a"]), (1, 12, 2, "c", "z", "3", ["a"])], q.schema)
    pairs = {(r.ord, r.q_ord, r.tier) for r in links.assign_answers(q, s).collect()}
    assert pairs == {(10, 5, "key"), (11, 1, "key"), (12, 7, "chapter")}
    assert {(r.ord, r.q_ord) for r in links.answer_scores(q, s).collect()} == {(10, 1), (11, 1), (12, 1)}


def test_graph(spark):
    nodes = spark.createDataFrame([("f", "formula", 3), ("e", "worked_example", 3), ("q", "question", 5), ("q2", "question", 4), ("s", "solution", 6)], "node_id string, kind string, page int")
    edges = spark.createDataFrame([("1", "e", "f", "USES_FORMULA"), ("2", "q", "f", "USES_FORMULA"), ("3", "s", "q", "ANSWER_OF"), ("4", "q2", "f", "USES_FORMULA"), ("5", "s", "q2", "ANSWER_OF"), ("6", "s", "zz", "NEAR"), ("7", "s", "q2", "ANSWER_OF")], "edge_id string, source_id string, target_id string, edge_type string")
    assert [tuple(r) for r in graph.chains(edges, nodes).collect()] == [("f", "e", "q2", "s")]
    assert graph.dangling(edges, nodes).count() == 1 and graph.known_ends(edges, nodes).count() == 6
    assert graph.evidence(edges).where("n_edges = 2").first().edge_id == "5"
    stats = sinks.graph_tables(nodes, edges).first()
    assert (stats.node_count, stats.edge_count, stats.node_type_counts["question"]) == (5, 7, 2)
    assert sinks.graph_tables(nodes.limit(0), edges.limit(0)).first().node_count == 0


def test_concepts(spark):
    segments = spark.createDataFrame([("s1", "the deferred maturity and capital"), ("s2", None), ("s3", "nothing here")], "segment_id string, text string")
    aliases = spark.createDataFrame([("c1", "Deferred maturity"), ("c2", "capital"), ("c3", "!!")], "concept_id string, alias string")
    assert {tuple(r) for r in concepts.phrase_links(segments, aliases).collect()} == {("s1", "c1"), ("s1", "c2")}
    got = concepts.concept_links(segments, aliases.withColumnRenamed("alias", "concept_text")).collect()
    assert {r.concept_id for r in got} == {"c1", "c2"}
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0])], "id long, v array<float>")
    near = concepts.nearest_vectors(v, "id", "v", v.where("id = 1"), k=1).collect()
    assert [(r.query_id, r.neighbour_id) for r in near] == [(1, 2)]


def test_tables(spark):
    c = spark.createDataFrame([("t", 1, 0, "a"), ("t", 1, 1, "x|y"), ("t", 2, 0, None), ("t", 2, 1, "4")], "segment_id string, row_index int, col_index int, raw_value string")
    assert tables.markdown(c).first().markdown == "| a | x\\|y |\n|---|---|\n|  | 4 |"
    n = spark.createDataFrame([("t", 1, 0, 2.0), ("t", 1, 1, 4.0), ("t", 2, 0, 3.0), ("t", 2, 1, 6.0), ("t", 2, 2, 5.0)], "segment_id string, row_index int, col_index int, num_value double")
    assert [(r.from_col, r.to_col, r.ratio) for r in tables.computed_columns(n).collect()] == [(0, 1, 2.0)]


LAYOUT = {"pdf_info": [{"page_idx": 0, "page_size": [600, 750], "para_blocks": [
    {"type": "title", "index": 4, "bbox": [1, 2, 3, 4], "lines": [{"spans": [{"type": "text", "content": "Chapter 1"}]}]},
    {"type": "text", "lines": [{"spans": [{"type": "text", "content": "a  b"}, {"type": "inline_equation", "content": "x"}]}, {"spans": []}]},
    {"type": "image", "index": 2, "blocks": [{"type": "caption", "lines": [{"spans": [{"type": "text", "content": "Figure 1"}, {"type": "image", "image_path": "i.png"}]}]}]},
    {"type": "table", "index": 3, "blocks": [{"type": "caption", "lines": [{"spans": [{"type": "text", "content": "Table 1"}]}]}]},
]}]}


def test_layout_source_stream_and_store(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "book.json").write_text(json.dumps(LAYOUT))
    rows = layout_json.layout_blocks(layout_json.read_layouts(spark, str(src))).orderBy("ord").collect()
    assert [(r.id, r.block_type, r.text) for r in rows] == [("p0_b4", "heading", "Chapter 1"), ("p0_b1", "text", "a b $x$"), ("p0_b2", "image", "Figure 1"), ("p0_b3", "table", "")]
    assert rows[0].doc_id == "book" and rows[1].x1 == 0.0 and rows[2].image_paths == ["i.png"]
    for _ in range(2):  # the second run sees no new file
        stream_layouts(spark, str(src), str(tmp_path / "store"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "store")).count() == 4
    sinks.append_new(spark.read.parquet(str(tmp_path / "store")).limit(2), str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 4


def test_catalogue_contents_and_cache(spark, tmp_path):
    f = tmp_path / "c.tsv"
    f.write_text("id\tname\talias\tTag(s)\tLevel\tPage(s)\n1\tYield\ta, b\tx;y\t2\t1-3\n")
    row = layout_json.read_concepts(spark, str(f)).first()
    assert (row.concept_id, row.concept_name, row.aliases, row.tags, row.concept_level, row.pages) == ("1", "Yield", ["a", "b"], ["x", "y"], 2, "1-3")
    pages = spark.createDataFrame([("d", 1, "Intro ..... iv\nOne ...... 12\nno entry")], "doc_id string, page_idx int, text string")
    assert [(r.title, r.page) for r in layout_json.contents_entries(pages).orderBy("pos").collect()] == [("Intro", 4), ("One", 12)]
    cache = sinks.open_cache(spark, str(tmp_path / "cache"))
    asked = spark.createDataFrame([("k",), ("k",)], "key string")
    hits, misses = sinks.split_hits(asked, cache)
    assert hits.count() == 0 and misses.count() == 1


def test_windows(spark):
    e = spark.createDataFrame([("a", 1.0, "2024-01-01 00:10:00"), ("a", 2.0, "2024-01-01 00:50:00"), ("a", 4.0, "2024-01-01 01:00:00")], "event_type string, value double, t string").withColumn("ts", F.to_timestamp("t"))
    assert sorted(r.sum_value for r in windowed_counts(e).collect()) == [3.0, 4.0]


def test_queries_have_matching_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(re.fullmatch(r"[a-z0-9_]+", n) for n in entry.queries())
