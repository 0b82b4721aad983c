"""Column functions on formulas and table cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import patterns as P
from quire.functions.text import any_of, contains_any, strip


def equation_number(text: Column) -> Column:
    """``(n.m)`` at the end, after an equation word, or in a tag; null if none."""
    found = [F.regexp_extract(text, p, 1) for p in P.EQUATION_NUMBER]
    return F.coalesce(*[F.when(f != "", F.concat(F.lit("("), f, F.lit(")"))) for f in found])


def canonical_key(text: Column) -> Column:
    """Hash of the formula without white space."""
    return F.md5(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""))


def symbols(text: Column) -> Column:
    """Sorted single letters and Greek letter names of a formula."""
    t = F.coalesce(text, F.lit(""))
    single = F.regexp_extract_all(t, F.lit(r"\b([a-zA-Z])\b"), F.lit(1))
    greek = F.regexp_extract_all(t, F.lit(rf"(?i)\b({'|'.join(P.GREEK)})\b"), F.lit(1))
    return F.array_sort(F.array_distinct(F.concat(single, greek)))


def usage_type(text: Column, heading_path: Column) -> Column:
    low, h = F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(heading_path, F.lit("")))
    mentions = any_of(low, [P.EQUATION_MENTION]) & any_of(low, [r"\b(?:use|from|by|see|as in|according to)\b"])
    return F.when(mentions, "reference").when(contains_any(h, ["key equations", "definition", "notation"]) | any_of(low, [r"\b(?:where|let|defined as|is defined as)\b"]), "definition").otherwise("application")


def short_meaning(text: Column, usage: Column, number: Column) -> Column:
    """One sentence on what a formula does, from its left side, symbols or number."""
    raw = strip(text)
    left = strip(F.get(F.split(raw, "=", 2), F.lit(0)))
    names = F.array_join(F.slice(symbols(text), 1, 4), ", ")
    tail = F.concat(F.lit(" ("), usage, F.lit(")."))
    return (
        F.when(raw == "", None)
        .when(F.contains(raw, F.lit("=")) & F.char_length(left).between(1, 24), F.concat(F.lit("Computes "), left, F.lit(" from related inputs"), tail))
        .when(names != "", F.concat(F.lit("Formula over variables "), names, tail))
        .when(number.isNotNull(), F.concat(F.lit("Equation "), number, tail))
        .otherwise(F.concat(F.lit("Mathematical relation"), tail))
    )


def needs_review(text: Column, number: Column) -> Column:
    """Formulas without equation sign, number and symbols, or long prose taken for one."""
    raw = strip(text)
    bare = ~F.contains(raw, F.lit("=")) & number.isNull()
    return (raw == "") | (bare & ((F.size(F.split(raw, r"\s+")) > 45) | (F.size(symbols(text)) == 0)))


def cell_type(value: Column) -> Column:
    """One of blank, formula, currency, percent, date, number, text; the first rule that holds."""
    v = strip(value)
    operator = v.rlike(r"^[=@]") | v.rlike(r"[+\-*/=]")
    return (
        F.when(v == "", "blank")
        .when(operator & contains_any(v, ["SUM", "AVG", "IF", "VLOOKUP", "="]), "formula")
        .when(v.rlike(r"^\$[\d,]+(\.\d{2})?$") | F.contains(F.upper(v), F.lit("USD")), "currency")
        .when(v.endswith("%") | F.contains(F.lower(v), F.lit("percent")), "percent")
        .when(v.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{2,4}"), "date")
        .when(F.regexp_replace(v, ",", "").rlike(r"^\d+(\.\d+)?$"), "number")
        .otherwise("text")
    )


def cell_number(value: Column, kind: Column) -> Column:
    """Number of a currency, percent or number cell; null where it isn't one."""
    bare = F.regexp_replace(value, r"[\$,\s]", "")
    return (
        F.when(kind == "currency", bare.try_cast("double"))
        .when(kind == "percent", F.regexp_replace(value, r"[%\s]", "").try_cast("double") / 100)
        .when(kind == "number", F.regexp_replace(value, r"[,\s]", "").try_cast("double"))
    )


def cell_address(row: Column, col: Column) -> Column:
    """``A1`` address of zero-based row and column; columns beyond Z have two letters."""
    letter = F.when(col < 26, F.char(F.lit(65) + col)).otherwise(F.concat(F.char(F.lit(64) + F.floor(col / 26).cast("int")), F.char(F.lit(65) + col % 26)))
    return F.concat(letter, (row + 1).cast("string"))


# Signs that make a token mathematical, words and functions that are no variables, units that are no symbols.
MATH_SIGN = r"[=∑√∫σπθλ+−×÷^/\\()\[\]]|\*\*"
PROSE_SIGN = r"[=∑√∫σπθλ+−×÷^/\\]|\*\*"
FORMULA_SIGN = r"[=∑√∫σπθλ+−×÷^∂∆]|\*\*"
INDEXED = r"[A-Za-z]\d|\d[A-Za-z]|[A-Za-z]_[A-Za-z]"
LABELLED = r"\(\d+\.\d+\)"
SYMBOL = r"[A-Za-zα-ωΑ-Ω][A-Za-z0-9_()]*"
COMMON_WORDS = [
    "the", "and", "or", "is", "are", "this", "that", "what", "which", "where", "when", "was", "were", "has", "have", "been", "will", "would", "should", "could", "may", "might", "can", "must", "shall",
    "for", "with", "from", "to", "of", "in", "on", "at", "by", "if", "then", "else", "let", "denote", "define", "here",
]
FUNCTION_NAMES = ["log", "ln", "exp", "max", "min", "sin", "cos", "tan", "sqrt", "abs", "sum", "prod", "mean", "var", "cov"]
UNIT_WORDS = ["year", "years", "month", "months", "day", "days", "percent", "percentage", "million", "billion", "bp", "bps", "basis", "points", "dollar", "dollars", "usd", "eur", "yen"]
GREEK_NAMES = ["alpha", "beta", "gamma", "delta", "sigma", "theta", "lambda", "rho", "pi", "mu", "nu", "epsilon", "eta", "phi", "psi", "omega"]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def _share(words: Column, pattern: str) -> Column:
    """Share of the words that match a pattern; 0 without words."""
    return F.size(F.filter(words, lambda w: w.rlike(pattern))) / F.greatest(F.size(words), F.lit(1))


def is_formula(text: Column) -> Column:
    """A mathematical sign, and three tenths of mathematical tokens or an equation label or word."""
    t = strip(text)
    words = _words(t)
    label = t.rlike(LABELLED)
    tiny = (F.char_length(t) <= 3) & ~t.rlike(r"[=+\-*/×÷∑∫√]")
    numbers = t.rlike(r"^[\d.\-%\s]+$") & (F.size(words) <= 2)
    index = t.rlike(r"^[A-Za-z]\s*=\s*-?\d+(?:\.\d+)?$")
    named = label | F.contains(t, F.lit("Eq.")) | F.contains(t, F.lit("Equation"))
    ratio = _share(words, f"{MATH_SIGN}|{INDEXED}")
    return ~((tiny | numbers | index) & ~label) & ((ratio >= 0.3) | named) & t.rlike(MATH_SIGN)


def is_formula_like(text: Column) -> Column:
    """A mathematical sign or an indexed name, in what is no link and no bare label."""
    t = strip(text)
    return (t != "") & ~t.rlike(r"(?i)https?://|www\.|\.com\b|\.edu\b|\.net\b") & ~t.rlike(r"^\(?\d+(?:\.\d+)+[a-z]?\)?$") & (t.rlike(FORMULA_SIGN) | t.rlike("[A-Za-z][_(]"))


def is_prose(text: Column) -> Column:
    """Eight words or more of which less than a fifth are mathematical."""
    words = _words(strip(text))
    return (F.size(words) >= 8) & (_share(words, PROSE_SIGN) < 0.2)


def is_equation_label(text: Column) -> Column:
    t = strip(text)
    return t.rlike(r"^\(?\d+(?:\.\d+)+[a-z]?\)?$") | t.rlike(r"(?i)\b(?:eq|equation)\.?\s*\d+(?:\.\d+)+")


def usage_in_context(context: Column) -> Column:
    """Usage of a formula from the text before it: definition, reference or application."""
    low = F.lower(F.coalesce(context, F.lit("")))
    return F.when(contains_any(low, ["where", "let", "define", "denote"]), "definition").when(low.rlike(r"(?:use|using|from|see|according to)\s+(?:eq|equation)"), "reference").otherwise("application")


def is_symbol(name: Column) -> Column:
    """A short name, a Greek letter or its name, or an indexed letter; no unit and no number."""
    short = name.rlike(r"^(?:[A-Za-z]{1,4}|[A-Za-zα-ωΑ-Ω]{1,3}_[A-Za-z0-9]{1,6}|[α-ωΑ-Ω])$")
    return ~F.lower(name).isin(UNIT_WORDS) & (F.lower(name).isin(GREEK_NAMES) | short)


def candidate_symbols(text: Column, most: int = 20) -> Column:
    """Sorted names in a formula that may be variables: no common word, no function, at most 15 characters."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({SYMBOL})"), F.lit(1))))
    return F.slice(F.filter(found, lambda x: ~F.lower(x).isin(COMMON_WORDS + FUNCTION_NAMES) & (F.char_length(x) <= 15)), 1, most)


def alignment(symbols_: Column, text: Column) -> Column:
    """Share of the symbols of formulas that a text mentions, in any case; 0 without symbols."""
    low = F.array_distinct(F.transform(F.coalesce(symbols_, F.array().cast("array<string>")), lambda x: F.lower(x)))
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.size(F.filter(low, lambda x: F.contains(t, x))) / F.greatest(F.size(low), F.lit(1))
