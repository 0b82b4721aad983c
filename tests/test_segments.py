"""Questions, segments, regions and backends on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from quire.functions import formulas as X
from quire.functions import qa
from quire.operators import concepts, graph, links, regions, segments
from quire.sources import backends

BLOCKS = "doc_id long, ord long, page_idx long, x0 double, y0 double, x1 double, y1 double, block_type string, text string"


def one(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def blocks(spark, *rows):
    return spark.createDataFrame([(1, i, p, 0.0, 400.0 + i, 10.0, 405.0 + i, k, t) for i, (p, k, t) in enumerate(rows)], BLOCKS)


def test_derivations(spark):
    texts = ["Proof of the rule: r = a", "We substitute r = 3 in Equation (2.1), therefore r = 4", "A proof of ownership", "Equation 3 shows the trend", "plain words", None, "a = 1\nb = 2 by derivation"]
    assert one(spark, lambda c: qa.is_derivation(qa.derivation_signs(c)), *texts) == [True, True, False, False, False, False, True]
    assert one(spark, lambda c: qa.derivation_score(qa.derivation_signs(c)), "Derivation", "")[1] == 0


def test_question_parts(spark):
    assert one(spark, qa.question_type, "Pick one. A. x B. y C. z", "Calculate it", "A scenario", "Explain this", "Explain " + "x" * 300, "Hm", None) == ["MCQ", "Calculation", "Case", "Short Answer", "Essay", "Mixed", "Mixed"]
    assert one(spark, qa.subparts, "Do (a) this (b) that", "none")[0] == [("a", "this"), ("b", "that")]
    assert one(spark, qa.given_data, "Given: a = 5, r_f = 2%, a = $1,000 x", None) == [{"a": "$1,000", "r_f": "2%"}, {}]
    assert one(spark, qa.output_variables, "find X, solve for y. z = 4", "find the", None) == [["X", "y", "z"], [], []]
    assert one(spark, qa.final_answer, "a\nThus b\nc = 3\nd", "a\nx = 2\nb", "a\nb", "", None) == ["Thus b", "x = 2", "b", None, None]
    assert one(spark, qa.steps, "First x = 1. Then we rest. Hence y = 2.", "a\nb") == [["First x = 1.", "Hence y = 2."], ["a", "b"]]
    assert one(spark, qa.numbered_parts, "intro\n1. one\nmore\n2) two", "none") == [["1. one\nmore", "2) two"], []]
    assert one(spark, qa.question_number, "Question 3.2", "q. 4)", "x", None) == ["3.2", "4", None, None]
    assert one(spark, qa.is_noisy_question, "Concept Check 9.5", "Word", "Two words", "What now?", "") == [True, True, True, False, True]
    assert one(spark, qa.definitions, "x = y where x is the annual yield and β_1 is the beta.", None) == [[("x", "annual yield"), ("β_1", "beta")], []]
    assert one(spark, qa.isbn, "ISBN-13: 978-0-306-40615-7", "none") == ["9780306406157", None]
    assert one(spark, lambda c: qa.solution_text(F.split(c, ";"), F.lit("4")), "a;b") == ["Step 1: a\nStep 2: b\nFinal answer: 4"]
    zones = spark.createDataFrame([("problem_set", "concept_check"), ("concept_check", "concept_check_solution"), ("other", "x")], "a string, b string")
    assert [r[0] for r in zones.select(qa.zones_fit(F.col("a"), F.col("b"))).collect()] == [False, True, True]


def test_definitions(spark):
    cases = [
        ("E(r_M) = r_f + b", "here E(r_M) denotes the market return, with r_f = riskless rate of return; and b is the slope of it all", [("E(r_M)", "market return"), ("r_f", "riskless rate of return"), ("b", "slope of it all")]),
        ("NPV = S - K", "Take it. S is the spot price. K is a strike price, S is the wrong price", [("S", "spot price"), ("K", "a strike price")]),
        ("σ + T", "The volatility of returns, denoted by σ, and the time left, denoted by T.", [("σ", "volatility of returns"), ("T", "and the time left")]),
        ("y = sigma_x", "where y is the cost and loading and sigma is the spread", [("y", "cost and loading")]),
        ("σ = y", "with sigma is the spread of prices", [("sigma", "spread of prices")]),
        # short meanings, refusals, units, no symbols, foreign symbols, names of functions
        ("r = sqrt(Q)", "where r is the rate. Q is not provided here", []),
        ("usd = r", "where usd is the currency, where r is the first rate, where r is the second rate", [("r", "first rate")]),
        ("r = sqrt(Q)", "where X is the other thing, where s is the letter of a function, here this is another thing. It is long known", []),
        ("r = 1", None, []),
        (None, "where r is the first rate", []),
    ]
    df = spark.createDataFrame([(i, f, t) for i, (f, t, _) in enumerate(cases)], "i int, f string, t string")
    got = [[(d.symbol, d.meaning) for d in x.v] for x in df.select("i", qa.formula_definitions(qa.definitions(F.col("t")), F.col("f")).alias("v")).orderBy("i").collect()]
    assert got == [want for _, _, want in cases]
    units = spark.createDataFrame([("r = 1", "where r is the interest rate (in percent), and so on")], "f string, t string")
    assert [tuple(d) for d in units.select(qa.formula_definitions(qa.definitions(F.col("t")), F.col("f"))).first()[0]] == [("r", "interest rate", "percent")]


def test_classification(spark):
    b = blocks(
        spark, (0, "heading", "Chapter 1: Yields"), (0, "text", "1. What is it?"), (0, "heading", "Problem Sets"), *[(0, "text", f"{i}. Calculate it") for i in (19, 20, 21)], (1, "text", "1. Find it"), (1, "text", "the rest"),
        (1, "heading", "Solutions to Concept Checks"), (1, "text", "1. It is 4 here"), (1, "text", "Solution to Question 3: 4 it is"), (1, "text", "Given: a = 2 + 1, thus the result"), (1, "text", "plain"), (1, "heading", "Key Terms"), (1, "text", None),
    )
    got = {r.ord: (r.section, r.segment_type) for r in segments.classify(b).collect()}
    assert got[1] == (None, "question") and got[3] == ("problem_set", "question") and got[6] == ("cfa", "question") and got[7] == ("cfa", None)
    assert got[9] == ("concept_check_solutions", "solution") and got[10][1] == "solution" and got[11][1] in ("calculation", "worked_example") and got[12][1] is None and got[13] == ("key_terms", "header") and got[14][1] is None
    merged = {r.ord: r.n_parts for r in segments.merge_questions(segments.classify(b)).collect()}
    assert merged[6] == 2 and merged[3] == 1
    assert segments.classify(b.limit(0)).count() == 0
    parts = segments.explode_numbered(blocks(spark, (0, "text", "1. a\n2. b"), (0, "text", "c"))).collect()
    assert sorted((r.ord, r.part, r.text) for r in parts) == [(0, 0, "1. a"), (0, 1, "2. b"), (1, 0, "c")]


def test_question_continuations(spark):
    def merged(*rows, section="Problem Sets"):
        b = blocks(spark, (0, "heading", section), *rows)
        return {r.ord: (r.n_parts, r.text) for r in segments.merge_questions(segments.classify(b)).collect()}

    long = "and " + "word " * 60 + "end."
    data = merged((0, "text", "5. Calculate it"), (0, "formula", "r = a + 4 (1.1)"), (0, "table", "Year 1 Year 2"), (0, "text", None), (0, "text", long), (1, "text", "3, 4"), (2, "text", "too late"))
    assert data[1] == (5, "\n".join(["5. Calculate it", "r = a + 4 (1.1)", "Year 1 Year 2", long, "3, 4"]))
    # beyond 1,200 characters only short blocks follow
    assert merged((0, "text", "5. Calculate it"), *[(0, "text", long)] * 5, (0, "text", "x = 4"), (0, "text", "so on"))[1][0] == 5
    assert merged((0, "text", "5. Calculate it"), *[(0, "text", long)] * 4, (0, "text", "x in 4"), (0, "text", "so on"))[1][0] == 7
    # a bare number takes what follows until it has more than 2,000 characters, a heading-like line too
    assert merged((0, "text", "11."), (0, "text", "Some Title Here"), *[(0, "text", long)] * 9)[1][0] == 9
    assert merged((0, "text", "11."), (0, "text", "one"), (0, "text", "12"), (0, "text", "two")) == {1: (2, "11.\none"), 3: (2, "12\ntwo")}
    assert merged((0, "text", "11."), (0, "text", "one"), section="Summary") == {}
    # lines of a table follow a table header at any length, other long blocks don't
    lines = merged((0, "text", "5. Find the beta of each " + "stock " * 210), (0, "text", "Stock A 4 5"), (0, "text", "Market Return"), (0, "text", long))[1]
    assert lines[0] == 3 and lines[1].endswith("Stock A 4 5\nMarket Return")
    # section markers, headings and heading-like lines end a question
    for kind, stop in [("text", "For Problems 5 to 8 use this"), ("heading", "a heading"), ("text", "Some Title Here"), ("text", "Solution to Question 3: it is 4")]:
        assert merged((0, "text", "5. Calculate it"), (0, "text", "and so on"), (0, kind, stop), (0, "text", "more"))[1][0] == 2
    assert merged((0, "text", "5. Calculate it"), (0, "table", "Some Title Here"))[1][0] == 2


def test_continuations_of_concept_checks(spark):
    def parts(*rows):
        b = blocks(spark, (0, "heading", "Concept Check"), (0, "text", "Concept Check 9.5 what is it"), *rows)
        return next(r.n_parts for r in segments.merge_questions(segments.classify(b)).collect() if r.ord == 1)

    b = (0, "text", "suppose that " + "word " * 60)
    assert parts((0, "text", "short prose"), b, (0, "text", "long " * 45)) == 3
    assert parts((0, "text", "why? " + "long " * 45)) == 2
    # blocks() lays blocks over each other, so no formula lies below the question
    assert parts((0, "formula", "r = 4")) == 1
    low = blocks(spark, (0, "heading", "Concept Check"), (0, "text", "Concept Check 9.5 what is it"), (0, "formula", "r = 4"), (0, "formula", "r = 5 (9.1)"))
    low = low.withColumns({"y0": F.col("ord") * 40.0, "y1": F.col("ord") * 40.0 + 20})
    assert [r.n_parts for r in segments.merge_questions(segments.classify(low)).collect()] == [2]
    assert [r.n_parts for r in segments.merge_questions(segments.classify(low.withColumn("x0", F.col("ord") * 100.0).withColumn("x1", F.col("x0") + 10))).collect()] == [1]


def test_chapters_and_pruning(spark):
    c = spark.createDataFrame([(1, "1"), (1, "3.2"), (1, "10"), (2, "2")], "doc_id long, number string")
    assert [(r.number, r.filled_in) for r in segments.chapter_gaps(c).where("doc_id = 1").orderBy("position").collect()] == [("1", False), ("3", True), ("3.1", True), ("3.2", False), ("10", False)]
    assert [(r.doc_id, r.number) for r in segments.contiguous_chapters(c).collect()] == [(1, "1")]
    s = spark.createDataFrame([("a", "short"), ("b", "short"), ("c", "Is this a question? Find it out now"), ("d", "This is a whole solution of the task.")], "segment_id string, text string")
    assert {r.segment_id for r in segments.prune_solutions(s, spark.createDataFrame([("a",)], "source_id string")).collect()} == {"a", "d"}
    b = blocks(spark, (0, "text", "therefore it is four"), (0, "text", "what?"), (0, "text", "therefore again"))
    assert [r.ord for r in segments.supplementary(b, b.where("ord = 2")).collect()] == [0]
    assert {r.chapter for r in segments.chapter_state(blocks(spark, (0, "text", "x"), (0, "heading", "2.1 A"), (0, "text", "y"))).collect()} == {None, "2"}


def test_regions(spark):
    b = blocks(spark, (0, "table", "t"), (0, "text", "Table 3.1 Yields"), (1, "table", "u"))
    near = regions.near_captions(b.where("block_type = 'table'"), b.withColumn("y0", F.col("y1") + 5)).collect()
    assert near == [] or near[0].ord == 0
    assert one(spark, lambda c: regions.caption_parts(c)["number"], "Figure 2.1 A", "as in Table 3", "none") == ["2.1", None, None]
    assert one(spark, regions.scaled_number, "$1.5M", "2,000", "-3k", "x", None) == [1.5e6, 2000.0, -3000.0, None, None]
    assert one(spark, regions.table_number, "Exhibit 4 of Figure 2", "none", None) == ["4", None, None]
    assert one(spark, regions.salvaged_json, 'Sure: ```json {"a": [1, 2]} ``` {"b": 3}', "{broken", None) == ['{"a": [1, 2]}', None, None]
    assert json.loads(one(spark, regions.salvaged_json, 'x [1, {"a": "}"}] y')[0]) == [1, {"a": "}"}]
    assert one(spark, regions.title_case, "A Title Here", "A title", None) == [True, False, False]
    stubs = regions.reference_stubs(spark.createDataFrame([("s", "see Table 1.2 and TABLE 1.2, Appendix B"), ("n", None)], "k string, t string"), "k", "t").collect()
    assert {(r.ref_type, r.ref_id) for r in stubs} == {("table", "1.2"), ("appendix", "B")}
    toc = spark.createDataFrame([(1, 7, "Yield basics", 3), (1, 8, "Nothing alike", 3)], "doc_id long, entry long, title string, page long")
    heads = spark.createDataFrame([(1, "Yield basic", 4, 40), (1, "Yield basics", 9, 90)], "doc_id long, title string, page long, ord long")
    assert [(r.entry, r.ord) for r in regions.aligned_contents(toc, heads).collect()] == [(7, 40)]
    box = [F.lit(float(v)) for v in (0, 0, 5, 400)]
    assert spark.range(1).select(regions.is_decorative(*box, 600.0, 750.0)).first()[0]
    assert regions.page_kind(spark.createDataFrame([(10, 0, 2), (500, 20, 0), (500, 0, 0), (None, None, None)], "n_chars int, n_lines int, n_images int")).select("page_type").collect()[3][0] == "unknown"


def test_backends(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "k long, q string")
    assert {r.status for r in backends.enrich(df, "none", "k", F.col("q")).collect()} == {"skipped"}
    backends.register("mock", backends.mock)
    got = {r.k: r.status for r in backends.enrich(df, "mock", "k", F.col("q")).collect()}
    assert got == {1: "ok", 2: "ok", 3: "empty"}
    books = spark.createDataFrame([("b", "T", None, "P"), ("b", "T", None, "P")], "book_id string, title string, edition string, publisher string")
    docs = spark.createDataFrame([(1, "b"), (2, None)], "doc_id long, book_id string")
    assert {(r.doc_id, r.title) for r in backends.book_metadata(docs, books).collect()} == {(1, "T"), (2, None)}


@pytest.mark.parametrize("rows, n", [([], 0), ([("s", "t", "NEAR")], 0)])
def test_empty_chains(spark, rows, n):
    from quire.operators import graph

    edges = spark.createDataFrame([("e", *r) for r in rows], "edge_id string, source_id string, target_id string, edge_type string")
    nodes = spark.createDataFrame([], "node_id string, kind string, page int")
    assert graph.chains(edges, nodes).count() == n


def test_question_and_reference_keys(spark):
    assert one(spark, qa.question_number, "Q 12 (a)", "Problem 3.2b", "7", "x", None, "nr 4 c") == ["12a", "3.2b", "7", None, None, "4c"]
    assert one(spark, qa.solution_number, "Solution to Q12(a).", "The answer to question 5: x", "For question 2 (b), x", "Question 9: y", "Question 9 y", None, "") == ["12a", "5", "2b", "9", None, None, None]
    assert one(spark, qa.leading_number, "3. x", " 14) y", "3 x", None) == ["3", "14", None, None]
    assert one(spark, qa.phrase_key, "The cost of capital in a firm today", "  ", "of the", None) == ["cost_capital_firm_today", None, None, None]
    df = spark.createDataFrame([("3.1", "12a", "concept_check"), ("Unknown", "1", None), ("4", None, "cfa"), ("4", "2", "cfa"), (None, "", None)], "ch string, num string, kind string")
    keys = [r[0] for r in df.select(qa.reference_key(F.col("ch"), F.col("num"), "Q", F.col("kind"))).collect()]
    assert keys == ["Ch3-Q12a-CC", None, None, "Ch4-Q2-CFA", None] and one(spark, qa.bare_key, "Ch3-Q12a-CC", "Ch4-S2") == ["Ch3-Q12a", "Ch4-S2"]
    made = [r[0] for r in df.select(qa.qa_key(F.col("ch"), F.col("kind"), F.col("num"))).collect()]
    assert made == ["3.1|concept_check|12a", "Unknown|other|1", "4|cfa|na", "4|cfa|2", "na|other|na"] and one(spark, qa.key_number, made[0], "a|b", None) == ["12a", "", ""]


def test_formula_predicates(spark):
    assert one(spark, X.is_formula, "y = a + b", "σ", "k = 1", "12.5 %", "the price (9.1) of x = y here", "the price is high and then it goes on = so", "(20.3)", None) == [True, False, False, False, True, False, True, False]
    assert one(spark, X.is_formula_like, "a_1 b", "www.x.com = 1", "(9.1)", "plain words", "") == [True, False, False, False, False]
    assert one(spark, X.is_prose, "one two three four five six seven eight", "a = b", "x = 1 + 2 ^ 3 one two three") == [True, False, False]
    assert one(spark, X.is_equation_label, "(9.1a)", "see Eq. 3.2", "9") == [True, True, False]
    assert one(spark, X.is_symbol, "NPV", "r_f", "α", "gamma", "years", "12", "wordy") == [True, True, True, True, False, False, False]
    assert one(spark, X.candidate_symbols, "where E(r_M) = log(x) + averyveryverylongname1", None) == [["E(r_M)", "log(x)"], []]
    assert one(spark, X.usage_in_context, "as we define it", "use equation 3", "plain", None) == ["definition", "reference", "application", "application"]
    df = spark.createDataFrame([(["X", "x", "y"], "the X is"), (None, "t"), (["z"], None)], "s array<string>, t string")
    assert [r[0] for r in df.select(X.alignment(F.col("s"), F.col("t"))).collect()] == [0.5, 0.0, 0.0]


def test_answer_signals(spark):
    schema = "id string, book_id string, chapter string, key string, formulas array<string>, concepts array<string>, text string"
    q = spark.createDataFrame([("q1", "b", "3", "3-1", ["f1"], None, "find the price of it"), ("q2", "b", "9", "9-2", None, None, "x"), ("q3", "b", "3", None, ["f1", "f2", "f3"], ["c"], "price of the bond")], schema)
    s = spark.createDataFrame([("s1", "b", "3", "3-1", None, None, "it is 5"), ("s2", "b", "3", "9-2", None, None, "x"), ("s3", "b", "3", None, ["f1", "f2", "f3", "f4"], ["c"], "price of the bond"), ("s4", "c", "3", "3-1", None, None, None)], schema)
    got = {(r.solution_id, r.question_id): r.score for r in links.answer_signals(q, s).collect()}
    assert got == {("s1", "q1"): 0.8, ("s3", "q3"): 0.75}
    assert links.answer_signals(q.limit(0), s).count() == 0
    with pytest.raises(ValueError):
        links.answer_signals(q, s, 0.5)


def test_concepts_by_words_and_keywords(spark):
    c = spark.createDataFrame([("c1", "Bond price", ["yield", "Coupon"], 1), ("c2", "Bond", None, 2), ("c3", None, ["bon"], 1)], "concept_id string, concept_name string, keywords array<string>, concept_level int")
    s = spark.createDataFrame([("a", "the bond market"), ("b", None), ("c", "price of a bond"), ("a", "the bond market")], "segment_id string, text string")
    assert {tuple(r) for r in concepts.fallback_concepts(s, c.where("concept_id <> 'c3'")).collect()} == {("a", "c2", 0.25), ("b", "c1", 0.1), ("c", "c1", 0.25)}
    got = {(r.segment_id, r.concept_id): (round(r.confidence, 6), r.method) for r in concepts.table_concepts(s, c).collect()}
    assert got == {("a", "c2"): (0.8, "keyword"), ("a", "c3"): (0.8, "keyword"), ("c", "c2"): (0.8, "keyword"), ("c", "c3"): (0.8, "keyword")}
    near = spark.createDataFrame([("a", "c2", 0.9), ("b", "c1", 0.5), ("b", "c2", 0.2)], "segment_id string, concept_id string, similarity double")
    both = {(r.segment_id, r.concept_id): (round(r.confidence, 6), r.method) for r in concepts.table_concepts(s, c, near).collect()}
    assert both["a", "c2"] == (1.0, "semantic+keyword") and both["b", "c1"] == (0.5, "semantic") and ("b", "c2") not in both
    m = spark.createDataFrame([("a", "n", "c1", 2, 0.9), ("a", "n", "c2", 1, 0.3), ("a", "n", "c3", 1, 0.5), ("a", "m", "c4", 3, 0.1)], "segment_id string, concept_name string, concept_id string, concept_level int, confidence double")
    assert {(r.concept_name, r.concept_id) for r in concepts.unique_concepts(m, "segment_id").collect()} == {("n", "c3"), ("m", "c4")}


def test_partial_chains_and_checks(spark):
    nodes = spark.createDataFrame([("f", "formula", 5), ("f2", "formula", 1), ("e1", "worked_example", 9), ("e2", "worked_example", 4), ("q", "question", 6), ("s", "solution", 7)], "node_id string, kind string, page int")
    edges = spark.createDataFrame([("e1", "f", "REFERENCES"), ("e2", "f", "EXPLAINS"), ("q", "f", "USES_FORMULA"), ("s", "q", "ANSWER_OF"), ("q", "gone", "EXPLAINS")], "source_id string, target_id string, edge_type string")
    rows = {r.formula_id: r for r in graph.partial_chains(edges, nodes).collect()}
    assert tuple(rows["f"]) == ("f", "e2", "q", "s", None, 3) and rows["f2"].n_hops == 0
    assert [r.formula_id for r in graph.fullest_chains(graph.partial_chains(edges, nodes)).collect()] == ["f"]
    segs = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "segment_id string")
    es = spark.createDataFrame([("a", "b", "T", 1.0, "m"), ("a", "x", "T", None, "m"), (None, "b", "T", 1.0, "m")], "source_id string, target_id string, edge_type string, strength double, anchor_metadata string")
    assert {r["check"]: r.n_bad for r in graph.graph_checks(segs, es).collect()} == {"missing_id": 1, "repeated_id": 1, "edge_fields": 2, "dangling_edge": 2}
    assert {r["check"]: r.n_bad for r in graph.graph_checks(segs.limit(0), es.limit(0)).collect()} == {"missing_id": 0, "repeated_id": 0, "edge_fields": 0, "dangling_edge": 0}


def test_backend_that_fails(spark):
    def broken(df):
        raise RuntimeError("no key")

    backends.register("broken", broken)
    rows = backends.enrich(spark.createDataFrame([(1, "a")], "id int, t string"), "broken", "id", F.col("t")).collect()
    assert rows[0].status == "error" and "no key" in rows[0].reason
