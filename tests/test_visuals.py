"""Page clusterings, sections and concept terms on small fixtures."""

from pyspark.sql import functions as F

from quire.operators import layout, visuals
from quire.plans import segments as segment_plans
from quire.plans import visuals as plans
from quire.plans.books import book_blocks

BLOCKS = "doc_id long, ord long, page_idx long, x0 double, y0 double, x1 double, y1 double, block_type string, text string"


def test_fragments(spark):
    rows = [(1, 0, 0, 0.0, 0.0, 9.0, 10.0, "formula", "a ="), (1, 1, 0, 5.0, 20.0, 9.0, 30.0, "formula", "b (1.2)"), (1, 2, 0, 0.0, 35.0, 9.0, 40.0, "formula", "c"), (1, 3, 0, 500.0, 38.0, 9.0, 44.0, "formula", None)]
    got = visuals.merge_fragments(spark.createDataFrame(rows, BLOCKS)).orderBy("ord").collect()
    assert [(r.ord, r.text, r.n_merged) for r in got] == [(0, "a = b (1.2)", 2), (2, "c", 1), (3, "", 1)]
    assert visuals.merge_fragments(spark.createDataFrame([], BLOCKS)).count() == 0


def test_columns_and_drawings(spark):
    w = spark.createDataFrame([(1, 0.0), (1, 3.0), (1, 100.0), (2, 5.0)], "page_id long, x double")
    assert [(r.page_id, r.centre, r.n_words) for r in visuals.cluster_columns(w, 10.0).orderBy("page_id", "col_no").collect()] == [(1, 1.5, 2), (1, 100.0, 1), (2, 5.0, 1)]
    b = spark.createDataFrame([(1, i, 0, 50.0 * i, 0.0, 50.0 * i + 10, 10.0, "image", "") for i in range(4)] + [(1, 9, 0, 900.0, 0.0, 910.0, 10.0, "image", "")], BLOCKS)
    assert [(r.seed, r.n_items, r.x1) for r in visuals.cluster_drawings(b).collect()] == [(0, 3, 110.0)]
    near = b.where("ord = 0").withColumn("x0", F.lit(2.0))
    assert {r.ord for r in visuals.unclaimed(b, near).collect()} == {1, 2, 3, 9}


def test_sections(spark):
    rows = [(1, 0, 0, 0.0, 0.0, 1.0, 1.0, "heading", "Chapter 1"), (1, 1, 0, 0.0, 0.0, 1.0, 1.0, "heading", "1.1 A"), (1, 2, 0, 0.0, 0.0, 1.0, 1.0, "text", "x"), (1, 3, 0, 0.0, 0.0, 1.0, 1.0, "heading", "1.2 B"), (1, 4, 0, 0.0, 0.0, 1.0, 1.0, "heading", "Chapter 2")]
    b = spark.createDataFrame(rows, BLOCKS)
    assert {(r.start_idx, r.subtree_end, r.n_filled) for r in visuals.prune_sections(layout.sections(b), b).collect()} == {(0, 3, 1), (1, 2, 1)}
    assert {r.page_idx for r in visuals.candidate_pages(b).collect()} == {0, 1}
    hints = spark.createDataFrame([(1, 0, "b", 2), (1, 0, "a", 1), (1, 0, "a", 1)], "doc_id long, page_idx long, zone string, weight int")
    assert visuals.page_votes(hints).first().zone == "a"


def test_question_pages(spark, tmp_path):
    rows = [(1, p, 0, 0.0, 0.0, 1.0, 1.0, "text", "x") for p in (1, 2, 5, 5)] + [(2, 7, 0, 0.0, 0.0, 1.0, 1.0, "text", "x")]
    got = visuals.candidate_pages(spark.createDataFrame([(d, i, p, *r) for i, (d, p, _, *r) in enumerate(rows)], BLOCKS)).collect()
    assert sorted((r.doc_id, r.page_idx) for r in got) == [(1, 1), (1, 2), (1, 3), (1, 5), (1, 6), (2, 7), (2, 8)]
    # four pages of twelve blocks, a question on each: every page counts, and the one after the last
    lines = [(40 * i, 1, i, i, 1.0, 5.0) for i in range(48)]
    names = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [(r.doc_id, r.n_pages) for r in plans.question_pages(spark, str(tmp_path)).collect()] == [(0, 5)]


def test_all_fragments_and_chapters(spark, tmp_path):
    lines = [(40 * i, 1, i, i, 1.0, 5.0) for i in range(72)]
    names = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    texts = book_blocks(spark, str(tmp_path)).where("block_type in ('formula', 'text')").count()
    got = plans.formula_fragments(spark, str(tmp_path)).collect()
    assert sum(r.n_merged for r in got) == texts == 48
    # pages 1 to 6 are headed Chapter 1, 1.2 to 1.5 and Chapter 2; only 1.1 is missing
    rows = segment_plans.filled_chapters(spark, str(tmp_path)).orderBy("position").collect()
    assert [(r.number, r.filled_in) for r in rows] == [("1", False), ("1.1", True), ("1.2", False), ("1.3", False), ("1.4", False), ("1.5", False), ("2", False)]


def test_fields(spark):
    a = spark.createDataFrame([("k", None, ""), ("z", "x", "y")], "k string, a string, b string")
    got = {r.k: (r.a, r.b) for r in visuals.backfill(a, spark.createDataFrame([("k", "1", "2")], "k string, a string, b string"), "k", ["a", "b"]).collect()}
    assert got == {"k": ("1", "2"), "z": ("x", "y")}
    r = spark.createDataFrame([(["a", "b", "c"],), ([],), (None,)], "r array<string>").select(visuals.derivation_roles(F.col("r")).alias("d")).collect()
    assert (r[0].d.inputs, r[0].d.target) == (["a", "b"], "c") and r[1].d is None and r[2].d is None
    p = spark.createDataFrame([([4, 2], None), (None, [0, 3]), (None, None)], "s array<int>, p array<int>").select(visuals.page_bounds(F.col("s"), F.col("p")).alias("b")).collect()
    assert [(x.b.page_start, x.b.page_end) for x in p] == [(3, 5), (1, 4), (1, 1)]
    assert spark.createDataFrame([([1.0],)], "v array<double>").select(visuals.box(F.col("v"))).first()[0] is None
    assert spark.createDataFrame([("the net present value",)], "t string").select(visuals.ngrams(F.col("t"))).first()[0] == ["net present value", "net present", "present value"]


def test_visual_concepts(spark):
    c = spark.createDataFrame([("c1", "Net present value (NPV)", None, ["cash"]), ("c2", "Value", ["worth"], None), ("c3", None, None, None)], "concept_id string, concept_name string, aliases array<string>, tags array<string>")
    terms = {(r.concept_id, r.term, r.role, r.generic) for r in visuals.concept_terms(c).collect()}
    assert ("c1", "npv", "acronym", False) in terms and ("c2", "value", "name", True) in terms and ("c2", "worth", "alias", False) in terms
    t = spark.createDataFrame([(1, "The NPV of cash"), (2, "value"), (3, None), (4, "its worth")], "visual_id long, text string")
    assert {(r.visual_id, r.concept_id) for r in visuals.visual_concepts(t, visuals.concept_terms(c)).collect()} == {(1, "c1"), (4, "c2")}
    assert visuals.visual_concepts(t, visuals.concept_terms(c.limit(0))).count() == 0
