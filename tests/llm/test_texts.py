"""Near-duplicates, leaks, scan repair and spam on small texts with every kind of dirt."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import leaks, neardup, scans, spam, words
from quire.operators import skew

VOCAB = [f"{a}{b}{c}" for a in "bcdfgl" for b in "aeiou" for c in ("nt", "rs", "ck", "mp", "ld")]


def _text(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def test_words():
    assert words.words_of("Ünï_code 2.5, naïve—x") == ["ünï", "code", "2", "5", "naïve", "x"] and words.words_of(None) == []
    h = np.arange(20, dtype=np.uint64)
    assert words.sliding_min(h[::-1].copy(), 9).tolist() == [int(h[::-1][i : i + 9].min()) for i in range(12)]
    assert len(words.shingle_hashes(h, 5)) == 16 and len(words.shingle_hashes(h[:3], 5)) == 0


def _edited(rng, text, share):
    ws = text.split()
    for i in rng.sample(range(len(ws)), int(len(ws) * share)):
        ws[i] = rng.choice(VOCAB) + str(rng.randrange(1000))
    return " ".join(ws)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        base = _text(rng, 40)
        rows.append((f"a{i}", base))
        rows += [(f"b{i}-{s}", _edited(rng, base, s)) for s in (0.0, 0.05, 0.1, 0.15)]
    rows += [("null", None), ("short", "one two three"), ("empty", ""), ("a0", rows[0][1]), (None, rows[0][1]), ("long", _text(rng, 20_000)), ("a1", rows[6][1])]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "segment_id string, text string, class_id string")
    links, members = neardup.near_duplicates(df, "segment_id", "text")
    got = {(r[0], r[1]) for r in neardup.record_pairs(links, members, "segment_id").collect()}
    sets = [(k, set(words.words_of(t))) for k, t in rows if k and t]
    want = {tuple(sorted((a, b))) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if a != b and min(len(x), len(y)) >= 12 and len(x & y) >= 0.7 * len(x | y)}
    assert got <= want and len(got) >= 0.98 * len(want) and len(want) > 300
    per = neardup.record_classes(links, members, "segment_id").collect()
    assert {r.segment_id for r in per} == {k for k, s in sets if len(s) >= 12}
    assert any(r.n_members > 1 for r in per)


def test_near_duplicates_with_a_hot_class(spark, monkeypatch):
    monkeypatch.setattr(skew, "FAIR_SHARE", 10)
    rng = random.Random(8)
    base = _text(rng, 40)
    rows = [(f"h{i:02}", base) for i in range(40)] + [(f"n{i}", _edited(rng, base, 0.05)) for i in range(3)] + [(f"r{i}", _text(rng, 40)) for i in range(40)]
    links, members = neardup.near_duplicates(spark.createDataFrame(rows, "segment_id string, text string"), "segment_id", "text")
    got = [(r[0], r[1]) for r in neardup.record_pairs(links, members, "segment_id").collect()]
    sets = [(k, set(words.words_of(t))) for k, t in rows]
    want = {tuple(sorted((a, b))) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if len(x & y) >= 0.7 * len(x | y)}
    assert set(got) == want and len(got) == len(want) >= 43 * 42 // 2


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "segment_id string, text string")
    links, members = neardup.near_duplicates(df, "segment_id", "text")
    assert neardup.record_pairs(links, members, "segment_id").count() == 0


def _leak_tables(spark):
    rng = random.Random(11)
    items = [(i, _text(rng, 30)) for i in range(20)] + [(98, "too short"), (99, None)]
    docs = [(100 + i, _text(rng, 200)) for i in range(20)]
    docs.append((1, "X " + items[3][1].upper().replace(" ", ",  ") + " y"))
    docs.append((2, " ".join(items[4][1].split()[5:18])))
    docs.append((3, " ".join(items[4][1].split()[5:17])))
    docs.append((4, _text(rng, 30_000) + " " + " ".join(items[7][1].split()[:13]) + " " + items[8][1]))
    docs += [(5, None), (6, ""), (1, docs[20][1])]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, t, "n") for k, t in items], "item_id long, item_text string, text string")


@pytest.mark.parametrize("chars", [leaks.BROADCAST_BYTES, 0])
def test_leaks(spark, chars):
    docs, items = _leak_tables(spark)
    got = {(r.doc_id, r.item_id) for r in leaks.leaked_items(docs, items, "doc_id", "text", "item_id", "item_text", broadcast_bytes=chars).collect()}
    assert got == {(1, 3), (2, 4), (4, 7), (4, 8)}
    share = {(r.doc_id, r.item_id): r.containment for r in leaks.leaked_items(docs, items, "doc_id", "text", "item_id", "item_text", broadcast_bytes=chars).collect()}
    assert share == {(1, 3): 1.0, (2, 4): pytest.approx(1 / 18), (4, 7): pytest.approx(1 / 18), (4, 8): 1.0}
    assert leaks.leaked_items(docs.limit(0), items, "doc_id", "text", "item_id", "item_text", broadcast_bytes=chars).count() == 0
    assert leaks.leaked_items(docs, items.limit(0), "doc_id", "text", "item_id", "item_text").count() == 0


@pytest.mark.parametrize("size", [leaks.BROADCAST_BYTES, 0])
def test_leaks_of_repetitive_texts(spark, size):
    # words repeat so often that minima tie within windows and one shingle stands in many places
    rng = random.Random(13)
    words_ = ["a", "b", "c"]
    items = [(i, " ".join(rng.choice(words_) for _ in range(rng.randrange(13, 40)))) for i in range(15)] + [(50, "a " * 20), (51, "a b " * 15)]
    docs = [(i, " ".join(rng.choice(words_) for _ in range(300))) for i in range(30)] + [(90, "a " * 400), (91, "b a " * 200)]
    docs += [(100 + i, "c c " + " ".join(items[i][1].split()[-13:]) + " b") for i in range(15)]
    runs = lambda t: [" ".join(t.split()[i : i + 13]) for i in range(len(t.split()) - 12)]
    want = {(d, k): sum(w in set(runs(t)) for w in runs(u)) / len(runs(u)) for d, t in docs for k, u in items if set(runs(t)) & set(runs(u))}
    out = leaks.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string"), "doc_id", "text", "item_id", "item_text", broadcast_bytes=size)
    assert {(r.doc_id, r.item_id): pytest.approx(r.containment) for r in out.collect()} == want and len(want) > 15


SENTENCE = "The {a} of the {b} measures every {c} near the origin, so readers should compare the {a} before the {c} hides it."


def _prose(rng, n):
    pick = lambda: rng.choice(VOCAB)
    return " ".join(SENTENCE.format(a=pick(), b=pick(), c=pick()) for _ in range(n))


def test_spam(spark):
    rng = random.Random(5)
    rows = [(i, _prose(rng, rng.randrange(3, 30)), "en") for i in range(300)]
    rows += [(1000, "buy cheap calculator online " * 60, "en"), (1001, "Free tutor! Buy tutor? Best tutor. " * 40, None), (1002, "\n".join(f"* [link {i % 7}](http://x.example/a-{i % 7})" for i in range(80)), "xx")]
    rows += [(2000, _prose(rng, 12) + "\nReferences\n" + "\n".join(f"[{i}] a b" for i in range(12)), "en"), (2001, None, "en"), (2002, "", "en"), (2003, "... !!", "en"), (2004, "x", "en")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, lang string, ratio string")
    out = {r.doc_id: r.is_spam for r in spam.spam_pages(df, "doc_id", "text", "lang").collect()}
    assert {k for k, v in out.items() if v} == {1000, 1001, 1002}
    assert 2001 not in out and 2002 not in out and 2003 not in out
    assert spam.spam_pages(df.limit(0), "doc_id", "text", "lang").count() == 0


def test_half_spam(spark):
    # 45 % of the words stand in sentences, the others in repeated keywords
    rng = random.Random(6)
    keywords = "buy cheap calculator online " * 55
    prose = _prose(rng, 8)
    assert 0.4 < spam.sentence_share(prose + "\n" + keywords)[0] < 0.5
    rows = [(i, _prose(rng, rng.randrange(3, 30)), "en") for i in range(300)]
    rows += [(1000, prose + "\n" + keywords, "en"), (1001, prose + "\n" + " ".join(f"{rng.choice(VOCAB)}{rng.randrange(10**6)}" for _ in range(220)), "en"), (1002, _prose(rng, 16) + "\n" + keywords, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in spam.spam_pages(df, "doc_id", "text", "lang").where("is_spam").collect()} == {1000}


def test_found_share_of_pairs():
    from math import comb

    def share(s):
        agree = sum(comb(neardup.SKETCH, k) * ((1 + s) / 2) ** k * ((1 - s) / 2) ** (neardup.SKETCH - k) for k in range(neardup.AGREE, neardup.SKETCH + 1))
        return agree * (1 - (1 - s**neardup.ROWS) ** neardup.BANDS)

    assert share(0.7) > 0.98 and share(0.72) > 0.99 and share(0.75) > 0.998 and share(0.8) > 0.9999


def test_sentence_share():
    assert spam.sentence_share("a b c") == (0.0, 3) and spam.sentence_share("...") == (1.0, 0)
    assert spam.sentence_share("This is one whole sentence with enough words.")[0] == 1.0


def test_furniture():
    yes = ["p. 361", "- 62 -", "Page 9", "CHAPTER 7 | 544", "~ 28 ~", "[176]", "22. Title of it   413", "READINGS IN HEDGE AND DRAWDOWN", "Chapter 6  Some title", "106  A TITLE"]
    assert all(scans.furniture(x, None) for x in yes)
    assert not any(scans.furniture(x, 5) for x in ["$294.", "reports 3.5", "with 18 periods to", "", "58", "The USD AND", "percent, but 12"]) and scans.furniture("6", 5) and not scans.furniture("6", None)
    text = "one line\nPage 3\nother line\nPage 4"
    assert [text[a:z] for a, z in scans.furniture_lines(text, 3)] == ["Page 3\n"]


@pytest.mark.parametrize("seen, word", [("f0rward", "forward"), ("periocls", "periods"), ("arnplifies", "amplifies"), ("volaule", "volatile"), ("stnke", "strike"), ("unle5s", "unless"), ("biidget", "budget"), ("diversiﬁed", "diversified"), ("whi(h", "which"), ("(ommittee", "committee")])
def test_confusions_are_cheap(seen, word):
    assert scans.cost(seen, word) <= scans.MOST_COST
    assert scans.deletes(seen) & scans.deletes(word)


def test_other_edits_are_not():
    assert scans.cost("forwards", "forward") == float("inf") and scans.cost("zanruove", "zanruola") == float("inf")


def test_numbers_and_cores():
    assert scans.number_cores("$441,Z79.7") == [(1, "441,Z79.7")] and scans.number_cores("(l.712%)") == [(1, "l.712")]
    assert not any(scans.number_cores(x) for x in ["BBB", "=SUM(B1:B8)", "12.5%", "hello", "B", "S5", "2nd", "$1,200"])
    assert [c for _, c in scans.cores("zero-coupon,")] == ["zero", "coupon"] and scans.cores("$$T_m^2$$") == [] and [c for _, c in scans.cores("supp|y.")] == ["supp|y"]
    assert [scans.cores(x)[0] for x in ["re(overy,", "(ommittee", "(see)", "(a)", "publi("]] == [(0, "re(overy"), (0, "(ommittee"), (1, "see"), (1, "a"), (0, "publi(")]


def test_scan_repair(spark):
    rng = random.Random(9)
    common = ["forward", "market", "period", "strike", "volatile", "holding", "zero", "coupon", "depends", "reader"]
    plain = [" ".join(rng.choice(common) for _ in range(30)) + " zero-coupon bond." for _ in range(120)]
    noisy = "(period The f0rward mar-\nket of\nPage 7\nthe periocl has a zero-\ncoupon hold\xad\ning at l.71% here."
    rows = [(i, t, "text", 6) for i, t in enumerate(plain)] + [(500, noisy, "text", 6), (500, noisy, "text", 6), (501, None, "text", None), (502, "", "text", 1), (503, "f0rward", "heading", 1), (504, "a zero-\ncoupon strike", "text", 1), (505, "Zanruove Fund", "text", 1)]
    blocks = spark.createDataFrame(rows, "block_key long, text string, block_type string, page_idx int")
    cells = spark.createDataFrame([(1, "$441,Z79.7"), (2, "BBB"), (3, None), (4, "12.5%"), (5, "Volat1le mark¢t")], "cell_id long, raw_value string")
    items = scans.texts(blocks, cells)
    found = {(r.item_source, r.item_id) for r in scans.noise(items).select("item_source", "item_id").distinct().collect()}
    assert found == {("blocks", "500"), ("cell_meta", "1"), ("cell_meta", "5")}
    out = {(r.item_source, r.item_id): r.repaired for r in scans.repair(items).collect()}
    assert out["blocks", "500"] == "(period The forward market of the period has a zero-coupon holding at 1.71% here."
    assert out["cell_meta", "1"] == "$441,279.7" and out["cell_meta", "5"] == "Volatile market" and out["blocks", "503"] == "f0rward"


def test_headers_in_mixed_case(spark):
    titles = scans.folded_titles(["Lectures on Synthetic contract and demand", None, " "])
    assert scans.furniture(" Lectures on synthetic contract and demand ", None, titles) and not scans.furniture("Lectures on synthetic contract", None, titles) and not scans.furniture(" ", None, titles)
    assert scans.furniture_lines("the first\nLectures on Synthetic contract and demand\nline\nLectures on Synthetic contract and demand", None, titles) == [(10, 52)]
    text = "the market of the re-\nLectures on Synthetic contract and demand\nader holds"
    rows = [(1, text, "text", 3, " BK_A "), (2, text, "text", 3, "bk_b"), (3, text, "text", 3, None), (4, "Lectures on Synthetic contract and demand\nthe market", "text", 3, "bk_a")]
    rows += [(10 + i, "the reader of the market holds", "text", 3, "bk_a") for i in range(9)]
    blocks = spark.createDataFrame(rows, "block_key long, text string, block_type string, page_idx int, book_id string")
    cells = spark.createDataFrame([(1, "12.5%")], "cell_id long, raw_value string")
    books = spark.createDataFrame([("bk_a", "Lectures on Synthetic contract and demand"), ("bk_a", None), ("bk_a", "Lectures on Synthetic contract and demand"), ("bk_b", "Other")], "book_id string, title string")
    items = scans.texts(blocks, cells, books)
    assert items.count() == 14
    assert {r.item_id for r in scans.noise(items).where("kind = 'f'").collect()} == {"1"}
    assert {r.item_id: r.repaired for r in scans.repair(items).collect() if r.item_source == "blocks"}["1"] == "the market of the reader holds"


def test_numbers_in_groups(spark):
    assert scans.grouped_numbers("$Z2\u00a0985\u00a0210 *") == [(1, "Z2\u00a0985\u00a0210")] and scans.grouped_numbers("1l3 321.5 bbl") == [(0, "1l3 321.5")]
    assert not any(scans.grouped_numbers(x) for x in ["354 bbl", "1 234", "Bob 123", "I 985", "12 boll", "2,354 bbl", "text"])
    blocks = spark.createDataFrame([], "block_key long, text string, block_type string, page_idx int")
    cells = spark.createDataFrame([(1, "$Z2\u00a0985\u00a0210 *"), (2, "$23 I98"), (3, "1 234")], "cell_id long, raw_value string")
    out = {r.item_id: (r.n_repairs, r.repaired) for r in scans.repair(scans.texts(blocks, cells)).collect()}
    assert out == {"1": (1, "$22\u00a0985\u00a0210 *"), "2": (1, "$23 198"), "3": (0, "1 234")}


def test_deletes_of_prefixes_find_the_same_pairs():
    rng = random.Random(3)
    for _ in range(2000):
        word = "".join(rng.choice("abcrnm") for _ in range(rng.randrange(9, 20)))
        seen = list(word)
        for _ in range(2):
            i = rng.randrange(len(seen))
            seen[i : i + 1] = [seen[i], rng.choice("xyz")] if rng.random() < 0.3 else [] if rng.random() < 0.4 else [rng.choice("xyz")]
        assert scans.deletes(word) & scans.deletes("".join(seen))
    assert max(len(scans.deletes("abcdefghijklmnopqrstuvwxyz" * 100)), 0) == 1 + 12 + 66


def test_long_and_short_tokens(spark):
    word = "hyper" * 12 + "x"
    plain = ["the value of the market is in the index of a bond " + word] * 40
    rows = [(i, t, "text", 6) for i, t in enumerate(plain)] + [(500, "value of the " + word.replace("p", "ρ", 1)[:-1] + "x", "text", 1), (501, "the " + word[:30].replace("e", "¢", 1) + word[30:] + " holds", "text", 1), (502, "value 0f the market", "text", 1), (503, "Zzz 0f it", "text", 1), (504, "an " + "q" * 5000 + "-\n" + "w" * 5000 + " end", "text", 1)]
    blocks = spark.createDataFrame(rows, "block_key long, text string, block_type string, page_idx int")
    cells = spark.createDataFrame([], "cell_id long, raw_value string")
    found = {r.item_id: r.fix for r in scans.noise(scans.texts(blocks, cells)).collect()}
    assert found == {"501": word, "502": "of", "504": "q" * 5000 + "w" * 5000}


def test_long_headers():
    assert scans.furniture("12  " + "a title " * 30, None) and not scans.furniture("12  " + "a title " * 30, None, width=60) and scans.furniture("12  A title of it", None, width=60)
    assert [len(p) for _, _, p in scans.line_breaks("a " + "b" * 300 + "-\nc")] == [302]


def test_word_filter(spark, monkeypatch):
    monkeypatch.setattr(scans, "PAGE_WORDS", 100)
    words = [f"wörd{i}" for i in range(1000)]
    pages = scans.filter_pages(spark.createDataFrame([(w,) for w in words], "token string"))
    assert len(pages) == 10
    f = scans.WordFilter(pages)
    assert all(w in f for w in words) and sum(f"x{i}" in f for i in range(5000)) < 50
    assert scans.filter_pages(spark.createDataFrame([], "token string")) == [] and "a" not in scans.WordFilter([])


def test_scan_repair_of_nothing(spark):
    blocks = spark.createDataFrame([], "block_key long, text string, block_type string, page_idx int")
    cells = spark.createDataFrame([], "cell_id long, raw_value string")
    items = scans.texts(blocks, cells)
    assert scans.noise(items).count() == 0 and scans.repair(items).count() == 0
    assert items.withColumn("x", F.lit(1)).count() == 0
