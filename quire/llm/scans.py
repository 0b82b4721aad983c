"""Repair of text from scanned pages: cut words, misread characters, page furniture.

One pass counts words and the pairs around line-end hyphens over all texts. Tokens that are rare
beside a much more frequent word, or hold a sign no word has, get candidates from a symmetric-delete
index over the lexicon (both sides emit their deletes, an equi-join finds the pairs). A weighted edit
distance in which known confusions are cheap keeps likely repairs; where several remain, the counts
of the preceding word with each of them decide. A second pass marks what is noisy, a third rewrites.
Deletes are made of the first ``PREFIX`` characters of a word only, which finds the same pairs with a bounded
number of rows; whole words are weighed. Which tokens a text should be marked for is told by a
Bloom filter in pages; what it passes wrongly falls out in the join with the repairs.

Defined results: null and empty texts are not noisy and stay as they are; repeated rows give one
result; a heading or formula block is no case; an unknown hyphenated pair is a compound if both halves
are words, else a cut word; ties between repairs go to the more frequent, then the smaller word; empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.units import MISREAD
from quire.session import cut

# What is printed, and what scanners read instead.
CONFUSIONS = [
    ("a", "@"), ("b", "6"), ("b", "h"), ("c", "("), ("c", "e"), ("cl", "d"), ("d", "cl"), ("e", "c"), ("e", "¢"), ("f", "t"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("g", "9"), ("h", "b"), ("i", "1"), ("i", "l"), ("i", "|"),
    ("ii", "u"), ("l", "1"), ("l", "|"), ("l", "i"), ("li", "h"), ("m", "rn"), ("n", "ri"), ("nn", "im"), ("o", "0"), ("ri", "n"), ("rn", "m"), ("s", "5"), ("t", "f"), ("ti", "u"), ("u", "ii"), ("u", "ti"), ("v", "y"), ("w", "vv"), ("y", "v"), ("z", "2"),
]
#: Cost of a known confusion; other edits cost one each. Repairs may cost so much at most.
CONFUSED, MOST_COST = 0.3, 0.65
#: A word without odd signs is taken for a misread one only if that is so many times as frequent.
TIMES = 25
#: Occurrences that make a word part of the lexicon.
LEAST = 5
#: Deletes that either side of the index makes, and the first characters of a word that it makes them of.
DELETES, PREFIX = 2, 12
#: A token as short as this has so many neighbours that a repair needs the word before it as a witness.
SHORT = 2
#: Words of a page of the Bloom filter, bits of a page, and bits that a word sets: of other words 1 in 200 passes.
PAGE_WORDS, PAGE_BITS, WORD_BITS = 40_000, 1 << 19, 4

HYPHENS = "-\xad‐¬"
BREAK = re.compile(rf"([{HYPHENS}])[ \t]*\r?\n\s*([^\W\d_]+)")
HALF = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*$")
EDGE = ".,;:?!()[]{}\"'“”‘’«»•*$%†‡" + HYPHENS
WORDLIKE = re.compile(r"[@¢|(]?[^\W_]+(?:[@¢|(]+[^\W_]+)*[@¢|(]?")
PLAIN = re.compile(r"[^\W\d_]+")
NUMERIC = re.compile(rf"[0-9{''.join(MISREAD)}]+(?:[.,  ][0-9{''.join(MISREAD)}]+)*")
_BLANKS = " \u00a0\u2009\u202f"
_DIGITS = "0-9" + "".join(MISREAD)
#: A number in groups; each group of three has a true digit, and so has the first or it is no word by itself.
GROUPED = re.compile(rf"(?<![^\W_])(?<![\d.,][{_BLANKS}])(?=[{_DIGITS}]*\d|[{_DIGITS}]{{1,3}}[\u00a0\u2009\u202f])[{_DIGITS}]{{1,3}}(?:[{_BLANKS}](?=[{_DIGITS}]{{0,2}}\d)[{_DIGITS}]{{3}}(?![^\W_]))+(?:[.,][{_DIGITS}]+(?![^\W_]))?")
MISREAD_SIGN = re.compile(f"[{''.join(MISREAD)}]")
FORMULA = re.compile(r"[_^\\={}*/+]")

PAGE = re.compile(r"(?:p|pp|s|pág|page|seite|página|blatt)\.?\s*\d{1,4}", re.I)
BARE = re.compile(r"\d{1,4}")
DRESSED = re.compile(r"(?:[-–—~*·]+|\[|\(|\|)\s*\d{1,4}\s*(?:[-–—~*·]+|\]|\)|\|)")
BARRED = re.compile(r"[^|]*\S\s+\|\s+\d{1,4}|\d{1,4}\s+\|\s+\S[^|]*")
TITLED = re.compile(r"\d{1,4}\s{2,}\S.*|\S.*\S\s{2,}\d{1,4}|[^\W\d_]+ \d{1,3}\s{2,}\S.*")
_LAST = frozenset("0123456789-–—~*·])|")


def furniture(line: str, page: int | None, titles: frozenset[str] = frozenset(), width: int | None = None) -> bool:
    """Whether a line is a running header or a page number; ``titles`` of the book are case-folded.

    A header is set on one line of the page, so it is at most twice as long as the longest other line (``width``).
    """
    x = line.strip()
    if titles and x.casefold() in titles:
        return True
    if not x or width is not None and len(x) > 2 * width:
        return False
    # what no pattern below can match is told by its ends, so most lines cost no regular expression
    if x.isupper():
        if len(PLAIN.findall(x)) >= 3 and not re.search(r"[.,;=$]", x):
            return True
    elif not (x[-1] in _LAST or "  " in x or "|" in x or "\t" in x):
        return False
    if BARE.fullmatch(x):
        return page is not None and abs(int(x) - page) <= 2
    return bool(PAGE.fullmatch(x) or DRESSED.fullmatch(x) or BARRED.fullmatch(x) or TITLED.fullmatch(x))


def folded_titles(titles: Iterable[str] | None) -> frozenset[str]:
    """Trimmed, case-folded titles; blank ones would make every blank line a header."""
    return frozenset(t.strip().casefold() for t in (() if titles is None else titles) if t and t.strip())


def furniture_lines(text: str, page: int | None, titles: frozenset[str] = frozenset()) -> list[tuple[int, int]]:
    """Bounds (with the line end) of furniture lines that have text lines before and after."""
    if "\n" not in text:
        return []
    lines, at, out = text.split("\n"), 0, []
    first, last = 0, len(lines) - 1
    while first < last and not lines[first].strip():
        first += 1
    while last > first and not lines[last].strip():
        last -= 1
    longest = sorted(((len(x.strip()), i) for i, x in enumerate(lines)), reverse=True)[:2]
    for i, x in enumerate(lines):
        if first < i < last and furniture(x, page, titles, longest[longest[0][1] == i][0]):
            out.append((at, at + len(x) + 1))
        at += len(x) + 1
    return out


def without_furniture(text: str, page: float | None, titles: Iterable[str] | None = None) -> tuple[str, list[tuple[int, int]]]:
    """The text with furniture lines (and their ends) blanked, so offsets hold, and their bounds."""
    if "\n" not in text:
        return text, []
    spans = furniture_lines(text, None if page is None or page != page else int(page), folded_titles(titles))
    for s, e in spans:
        text = text[:s] + " " * (e - s) + text[e:]
    return text, spans


def cores(token: str) -> list[tuple[int, str]]:
    """Word-like parts of a token without its punctuation: (offset, part)."""
    if FORMULA.search(token):
        return []
    a, z = 0, len(token)
    while a < z and token[a] in EDGE:
        a += 1
    while z > a and token[z - 1] in EDGE:
        z -= 1
    # an open bracket may be a letter that was misread; a closed one is punctuation
    if ")" not in token:
        if a and token[a - 1] == "(" and token[a:z]:
            a -= 1
        if z < len(token) and token[z] == "(" and token[a:z]:
            z += 1
    out = []
    for part in re.finditer(r"[^-‐]+", token[a:z]):
        if WORDLIKE.fullmatch(part[0]) and PLAIN.search(part[0]):
            out.append((a + part.start(), part[0]))
    return out


def misread_number(core: str) -> bool:
    """A number in which letters stand for digits."""
    digits = sum(c.isdigit() for c in core)
    return bool(digits and not core.replace(",", "").replace(".", "").isdigit() and NUMERIC.fullmatch(core) and (digits >= 2 or re.search(r"[.,]", core)))


def number_cores(token: str) -> list[tuple[int, str]]:
    """The number in a token, if any, without sign, currency, unit signs and punctuation."""
    m = re.search(rf"[0-9{''.join(MISREAD)}][0-9{''.join(MISREAD)}.,]*", token)
    if not m or token.startswith("=") or token[: m.start()].strip("-−–+($USD") or re.match(r"[^\W_]", token[m.end() :]) and not re.fullmatch(r"(?:k|m|bn|th)?\W*", token[m.end() :]):
        return []
    core = m[0].rstrip(".,")
    return [(m.start(), core)] if misread_number(core) else []


def grouped_numbers(text: str) -> list[tuple[int, str]]:
    """Numbers whose groups of three stand between blanks and hold a misread digit: (offset, number)."""
    return [(m.start(), m[0]) for m in GROUPED.finditer(text) if sum(c.isdigit() for c in m[0]) >= 2 and MISREAD_SIGN.search(m[0])]


def deletes(word: str, most: int = DELETES, prefix: int = PREFIX) -> set[str]:
    """The first characters of a word and all they can become by deleting up to ``most`` of them."""
    word = word[:prefix]
    out = {word}
    for k in range(1, min(most, len(word) - 1) + 1):
        for gone in combinations(range(len(word)), k):
            out.add("".join(c for i, c in enumerate(word) if i not in gone))
    return out


def cost(seen: str, word: str, most: float = MOST_COST) -> float:
    """Weighted edit distance from ``word`` as printed to ``seen``; infinite beyond ``most``."""
    n, m = len(word), len(seen)
    rows = [[1e9] * (m + 1) for _ in range(n + 1)]
    rows[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            here = rows[i][j]
            if here > most:
                continue
            if i < n and j < m:
                step = here + (word[i] != seen[j])
                if step < rows[i + 1][j + 1]:
                    rows[i + 1][j + 1] = step
            if i < n and here + 1 < rows[i + 1][j]:
                rows[i + 1][j] = here + 1
            if j < m and here + 1 < rows[i][j + 1]:
                rows[i][j + 1] = here + 1
            for a, b in CONFUSIONS:
                if word.startswith(a, i) and seen.startswith(b, j) and here + CONFUSED < rows[i + len(a)][j + len(b)]:
                    rows[i + len(a)][j + len(b)] = here + CONFUSED
    return rows[n][m] if rows[n][m] <= most else float("inf")


def line_breaks(text: str) -> list[tuple[int, int, str]]:
    """Bounds of words with a hyphen at a line end, and both halves with the mark, lower-cased."""
    out = []
    if "\n" in text:
        for m in BREAK.finditer(text):
            back = 64
            while (left := HALF.search(text[max(0, m.start() - back) : m.start()])) and left.start() == 0 and back < m.start():
                back *= 4  # the half may begin before what was looked at
            if left:
                out.append((m.start() - len(left[0]), m.end(), f"{left[0].lower()}{m[1]}{m[2].lower()}"))
    return out


def blanked(text: str, spans: list) -> str:
    """The text with the words of ``spans`` blanked, so halves of cut words count as no words."""
    for s, e, *_ in spans:
        text = text[:s] + " " * (e - s) + text[e:]
    return text


def texts(blocks: DataFrame, cells: DataFrame, books: DataFrame | None = None) -> DataFrame:
    """Uniform rows (item_source, item_id, text, page, titles, prose) of blocks and cells.

    ``titles`` are those of the block's book, which are headers where they stand on a line of their own.
    """
    titles = F.lit(None).cast("array<string>")
    if books is not None:
        key = F.lower(F.trim("book_id"))
        named = books.groupBy(key.alias("_book")).agg(F.collect_set("title").alias("_titles"))
        blocks, titles = blocks.withColumn("_book", key).join(named, "_book", "left"), F.col("_titles")
    b = blocks.select(F.lit("blocks").alias("item_source"), F.col("block_key").cast("string").alias("item_id"), "text", F.col("page_idx").cast("int").alias("page"), titles.alias("titles"), (~F.coalesce(F.col("block_type"), F.lit("")).isin("heading", "formula")).alias("prose"))
    c = cells.select(F.lit("cell_meta").alias("item_source"), F.col("cell_id").cast("string").alias("item_id"), F.col("raw_value").alias("text"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("array<string>").alias("titles"), F.lit(True).alias("prose"))
    return b.unionByName(c).where(F.col("item_id").isNotNull() & (F.col("text") != ""))


def word_counts(items: DataFrame) -> DataFrame:
    """(kind, token, n, n_lower): words ('w'), compounds as written ('c'), halves at line ends ('h')."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        low: Counter = Counter()
        for b in batches:
            raw: Counter = Counter()
            for t, page, titles in zip(b["text"], b["page"], b["titles"]):
                if "\n" in t:
                    t, _ = without_furniture(t, page, titles)
                    broken = line_breaks(t)
                    total.update(("h", pair) for _, _, pair in broken)
                    t = blanked(t, broken)
                raw.update(t.split())
            for token, n in raw.items():
                parts = cores(token)
                for _, p in parts:
                    total["w", p.lower()] += n
                    if p[0].islower() or not p[0].isalpha():
                        low["w", p.lower()] += n
                if len(parts) > 1:
                    total["c", token.strip(EDGE).lower()] += n
            if len(total) > 200_000:
                yield _count_rows(total, low)
                total, low = Counter(), Counter()
        yield _count_rows(total, low)

    rows = items.where("prose").select("text", "page", "titles").mapInPandas(count, "kind string, token string, n long, n_lower long")
    return cut(rows.groupBy("kind", "token").agg(F.sum("n").alias("n"), F.sum("n_lower").alias("n_lower")), "words")


def _count_rows(total: Counter, low: Counter) -> pd.DataFrame:
    return pd.DataFrame([(k, t, n, low[k, t]) for (k, t), n in total.items()], columns=["kind", "token", "n", "n_lower"])


def cut_words(counts: DataFrame) -> DataFrame:
    """(pair, joined) of the halves at line ends that are one word."""
    pattern = rf"^(.*)([{HYPHENS}])([^{HYPHENS}]+)$"
    pairs = counts.where("kind = 'h'").select(F.col("token").alias("pair"), F.regexp_extract("token", pattern, 1).alias("l"), F.regexp_extract("token", pattern, 2).alias("mark"), F.regexp_extract("token", pattern, 3).alias("r"))
    pairs = pairs.withColumns({"joined": F.concat("l", "r"), "compound": F.concat("l", F.lit("-"), "r"), "last": F.element_at(F.split("l", "-"), -1)})
    pairs = pairs.withColumn("tail", F.concat("last", "r"))
    w = counts.where("kind = 'w'")
    c = counts.where("kind = 'c'")

    def named(df: DataFrame, key: str, n: str) -> DataFrame:
        return df.select(F.col("token").alias(key), F.col("n").alias(n))

    known = (
        pairs.join(named(w, "tail", "n_tail"), "tail", "left").join(named(c, "compound", "n_compound"), "compound", "left")
        .join(named(w, "last", "n_last"), "last", "left").join(named(w, "r", "n_r"), "r", "left").na.fill(0, ["n_tail", "n_compound", "n_last", "n_r"])
    )
    split = (F.col("mark") == "\xad") | (F.col("mark") == "¬")
    halves = (F.col("n_last") >= LEAST) & (F.col("n_r") >= LEAST)
    is_cut = split | (F.col("n_tail") > F.col("n_compound")) | ((F.col("n_tail") == F.col("n_compound")) & ~halves)
    return known.where(is_cut).select("pair", "joined")


def _delete_rows(df: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [np.fromiter((xxhash.xxh3_64_intdigest(x) for x in deletes(w)), np.uint64).view(np.int64) for w in b["token"]]
            at = np.repeat(np.arange(len(b)), [len(s) for s in sets])
            yield pd.DataFrame({"d": np.concatenate(sets or [np.zeros(0, np.int64)]), "token": b["token"].to_numpy()[at], "n": b["n"].to_numpy()[at]})

    return df.select("token", "n").repartition(2 * df.sparkSession.sparkContext.defaultParallelism, "token").mapInPandas(emit, "d long, token string, n long")


def repairs(counts: DataFrame) -> DataFrame:
    """(token, word, cost, n): likely printed words of each noisy token."""
    w = counts.where((F.col("kind") == "w") & (F.char_length("token") > 1))
    plain = F.col("token").rlike(r"^\p{L}+$")
    lexicon = w.where(plain & (F.col("n_lower") >= LEAST))
    # a bracket before or after a word of the lexicon is punctuation, no misread letter
    words = lexicon.select(F.col("token").alias("bare"))
    odd = w.where(~plain).withColumn("bare", F.regexp_replace("token", r"^\(|\($", "")).join(words, "bare", "left_anti").drop("bare")
    # a plain token may be a misread one only if it isn't as frequent as any word it could stand for
    top = F.lit(lexicon.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])
    rare = w.where(plain & (F.col("n_lower") > 0) & (F.col("n") * TIMES <= top))
    left = _delete_rows(odd.unionByName(rare)).withColumnsRenamed({"token": "seen", "n": "n_seen"})
    pairs = left.join(_delete_rows(lexicon).withColumnRenamed("token", "word"), "d").where("seen <> word")
    pairs = pairs.where(F.abs(F.char_length("seen") - F.char_length("word")) <= DELETES)
    pairs = pairs.where((~F.col("seen").rlike(r"^\p{L}+$")) | (F.col("n_seen") * TIMES <= F.col("n"))).select("seen", "word", "n").distinct()

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, x, cost(s, x), n) for s, x, n in zip(b["seen"], b["word"], b["n"])]
            yield pd.DataFrame([r for r in rows if r[2] <= MOST_COST], columns=["token", "word", "cost", "n"])

    return cut(pairs.mapInPandas(weigh, "token string, word string, cost double, n long"), "repairs")


class WordFilter:
    """Words that may be in a set: all of the set and one in 200 of the others."""

    def __init__(self, pages: list[bytes]):
        self.pages = pages

    @staticmethod
    def bits(word: str) -> tuple[int, list[int]]:
        """Hash of the word (the same as ``xxhash64`` of Spark) and its bits in a page."""
        data = word.encode("utf-8", "surrogatepass")
        h = xxhash.xxh3_64_intdigest(data)
        return xxhash.xxh64_intdigest(data, seed=42), [(h >> (16 * j)) % PAGE_BITS ^ (h >> 45) % PAGE_BITS * j % PAGE_BITS for j in range(WORD_BITS)]

    def __contains__(self, word: str) -> bool:
        if not self.pages:
            return False
        h, bits = self.bits(word)
        page = self.pages[(h - (1 << 64) if h >> 63 else h) % len(self.pages)]
        return all(page[i >> 3] >> (i & 7) & 1 for i in bits)


def filter_pages(words: DataFrame) -> list[bytes]:
    """Pages of a :class:`WordFilter` of the distinct ``token`` of ``words``: some 13 bits a word go to the driver."""
    pages = -(-words.count() // PAGE_WORDS)
    if not pages:
        return []

    def page(b: pd.DataFrame) -> pd.DataFrame:
        at = np.array([x for w in b["token"] for x in WordFilter.bits(w)[1]], np.int64)
        bits = np.zeros(PAGE_BITS, np.uint8)
        bits[at] = 1
        return pd.DataFrame({"part": b["part"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    rows = words.select("token", F.pmod(F.xxhash64("token"), F.lit(pages)).cast("int").alias("part")).groupBy("part").applyInPandas(page, "part int, bits binary")
    out = [bytes(PAGE_BITS // 8)] * pages
    for r in rows.toLocalIterator():
        out[r["part"]] = bytes(r["bits"])
    return out


MARKS = "kind string, item_source string, item_id string, h long, start int, stop int, a string, b string, n long"


def marks(items: DataFrame, fixes: DataFrame) -> DataFrame:
    """What may be noisy in each text, and the counts of words before ambiguous repairs.

    Kinds: 'f' furniture line, 'n' misread number, 'h' halves at a line end, 'w' noisy token, 'g' count
    of a pair of words.
    """
    sc = items.sparkSession.sparkContext
    several = fixes.groupBy("token").agg(F.count("*").alias("c")).where((F.col("c") > 1) | (F.char_length("token") <= SHORT)).select("token")
    noisy_, choice_ = (sc.broadcast(filter_pages(x)) for x in (fixes.select("token").distinct(), fixes.join(several, "token", "left_semi").select(F.col("word").alias("token")).distinct()))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        noisy, choice = WordFilter(noisy_.value), WordFilter(choice_.value)
        memo: dict[str, tuple] = {}
        for b in batches:
            out, grouped, pairs = [], [], Counter()
            for source, item, h, text, page, titles in zip(b["item_source"], b["item_id"], b["h"], b["text"], b["page"], b["titles"]):
                text, lines = without_furniture(text, page, titles)
                for s, e in lines:
                    out.append(("f", source, item, h, s, e, None, None, 0))
                broken = line_breaks(text)
                out += [("h", source, item, h, s, e, pair, None, 0) for s, e, pair in broken]
                clean = blanked(text, broken)
                whole = grouped_numbers(clean) if source == "cell_meta" else []
                grouped += [("n", source, item, h, o, o + len(c), c, None, 0) for o, c in whole]
                at, before = 0, ""
                for token in clean.split():
                    known = memo.get(token)
                    if known is None:
                        if len(memo) > 500_000:
                            memo.clear()
                        words_ = [(o, p.lower(), len(p), p.lower() in noisy, p.lower() in choice) for o, p in cores(token)]
                        numbers = number_cores(token)
                        plain = not numbers and not any(n or c for *_, n, c in words_)
                        known = memo[token] = (plain, words_[-1][1] if words_ else "", words_, numbers)
                    plain, last, words_, numbers = known
                    if plain:
                        before = last or before
                        continue
                    for o, low, size, is_noisy, is_choice in words_:
                        if is_noisy:
                            at = clean.index(token, at)
                            out.append(("w", source, item, h, at + o, at + o + size, low, before, 0))
                        if before and is_choice:
                            pairs[before, low] += 1
                        before = low
                    if numbers:
                        at = clean.index(token, at)
                        out += [("n", source, item, h, at + o, at + o + len(c), c, None, 0) for o, c in numbers if not any(s <= at + o < s + len(w) for s, w in whole)]
            out += grouped
            out += [("g", "", "", 0, 0, 0, x, y, n) for (x, y), n in pairs.items()]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in MARKS.split(", ")])

    return cut(items.where("prose").withColumn("h", F.xxhash64("text")).select("item_source", "item_id", "h", "text", "page", "titles").mapInPandas(mark, MARKS), "marks")


ITEM = ["item_source", "item_id", "h"]


def noise(items: DataFrame) -> DataFrame:
    """Every noisy span (kind, item_source, item_id, h, start, stop, fix) of the texts."""
    counts = word_counts(items)
    fixes = repairs(counts)
    found = marks(items, fixes)
    place = [*ITEM, "start", "stop"]
    furniture_ = found.where("kind = 'f'").select("kind", *place, F.lit("").alias("fix"))
    digits = F.translate("a", "".join(MISREAD), "".join(MISREAD.values()))
    numbers = found.where("kind = 'n'").select("kind", *place, digits.alias("fix"))
    joined = found.where("kind = 'h'").join(cut_words(counts), F.col("a") == F.col("pair")).select("kind", *place, F.col("joined").alias("fix"))
    pairs = found.where("kind = 'g'").groupBy(F.col("a").alias("b"), F.col("b").alias("word")).agg(F.sum("n").alias("together"))
    # a repair depends on the token and the word before it only: choose once for each such pair
    seen = found.where("kind = 'w'").select(F.col("a").alias("token"), "b").distinct()
    score: Column = F.log(F.col("n")) - 8 * F.col("cost") + 2 * F.log1p(F.coalesce("together", F.lit(0)))
    best = Window.partitionBy("token", "b").orderBy(F.desc("score"), F.desc("n"), "word")
    chosen = seen.join(fixes, "token").join(pairs, ["b", "word"], "left").where((F.char_length("token") > SHORT) | F.col("together").isNotNull()).withColumn("score", score).withColumn("rank", F.row_number().over(best)).where("rank = 1").select(F.col("token").alias("a"), "b", F.col("word").alias("fix"))
    words = found.where("kind = 'w'").join(chosen, ["a", "b"]).select("kind", *place, "fix")
    return furniture_.unionByName(numbers).unionByName(joined).unionByName(words)


def repaired_text(text: str, spans: list) -> str:
    """Apply spans (start, stop, kind, fix), drop furniture, join lines of a paragraph."""
    out, at = [], 0
    for start, stop, kind, fix in sorted(spans, key=lambda s: (s[0], s[0] - s[1])):
        if start < at:
            continue
        old = text[start:stop]
        if kind != "n" and fix and old[:1].isupper():
            fix = fix[:1].upper() + fix[1:]
        out += [text[at:start], fix]
        at = stop
    whole = "".join(out) + text[at:]
    whole = re.sub(r"(?<=[^\W\d_][-‐])[ \t]*\r?\n[ \t]*(?=[^\W\d_])", "", whole)  # a compound broken at its own hyphen
    paragraphs = [re.sub(r"[ \t]*\r?\n[ \t]*", " ", p).strip() for p in re.split(r"\n[ \t]*\n", whole)]
    return "\n\n".join(p for p in paragraphs if p)


def repair(items: DataFrame) -> DataFrame:
    """(item_source, item_id, n_repairs, repaired) of every distinct text."""
    spans = noise(items).groupBy(*ITEM).agg(F.collect_list(F.struct("start", "stop", "kind", "fix")).alias("spans"))
    rows = items.withColumn("h", F.xxhash64("text")).select(*ITEM, "text", "prose").distinct().join(spans, ITEM, "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            spans_ = [[tuple(s.values()) if isinstance(s, dict) else tuple(s) for s in x] if x is not None else [] for x in b["spans"]]
            new = [repaired_text(t, s) if p else t for t, s, p in zip(b["text"], spans_, b["prose"])]
            yield pd.DataFrame({"item_source": b["item_source"], "item_id": b["item_id"], "n_repairs": [len(s) for s in spans_], "repaired": new})

    return rows.mapInPandas(run, "item_source string, item_id string, n_repairs int, repaired string")
