"""A grammar of numbers and unit expressions with dimensions as exponent vectors.

A unit is an exponent vector over base dimensions with a factor and an offset to the base units. Every unit
expression, a single name as well as ``MWh per day``, is the product of such units; two expressions are of one
quantity if their vectors are equal, and factors and offsets carry a number from one to the other. A catalogue adds
names of its own, and what it says of a known name holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, replace
from fractions import Fraction

# Characters that scanned digits are misread as, and the digit each stands for.
MISREAD = {"O": "0", "o": "0", "l": "1", "I": "1", "Z": "2", "S": "5", "b": "6", "B": "8", "g": "9"}

#: Base dimensions of the exponent vectors. A proportion is one, as a bare number is no rate unless it is named so.
BASES = ("money", "mass", "length", "time", "temperature", "proportion")
# Name, other spellings, size in units above it (a base stands for itself), offset, prefixes of its symbols.
DEFINITIONS = [
    ("US dollar", "$|us$|usd|dollar", "money", "", ""),
    ("US cent", "¢|cent", "1/100 US dollar", "", ""),
    ("gram", "g", "mass", "", "k"),
    ("kilogram", "kilo", "1000 gram", "", ""),
    ("metric tonne", "t|tonne|metric ton", "1000 kilogram", "", ""),
    ("pound", "lb", "0.45359237 kilogram", "", ""),
    ("troy ounce", "ozt|oz t|troy oz", "31.1034768 gram", "", ""),
    ("metre", "meter", "length", "", ""),
    ("litre", "liter", "1/1000 metre^3", "", ""),
    ("US gallon", "gal|gallon", "3.785411784 litre", "", ""),
    ("barrel", "bbl", "42 US gallon", "", ""),
    ("second", "s|sec", "time", "", ""),
    ("minute", "min", "60 second", "", ""),
    ("hour", "h|hr", "60 minute", "", ""),
    ("day", "d", "24 hour", "", ""),
    ("week", "wk", "7 day", "", ""),
    ("year", "yr", "365 day", "", ""),
    ("quarter", "qtr", "1/4 year", "", ""),
    ("month", "mo|mth", "1/12 year", "", ""),
    ("watt", "w", "kilogram metre^2 second^-3", "", "kmgt"),
    ("joule", "j", "watt second", "", "kmgt"),
    ("watt hour", "wh", "watt hour", "", "kmgt"),
    ("kelvin", "°k", "temperature", "", ""),
    ("degree Celsius", "°c|celsius|deg c|degrees celsius", "kelvin", "273.15", ""),
    ("degree Fahrenheit", "°f|fahrenheit|deg f|degrees fahrenheit", "5/9 kelvin", "45967/180", ""),
    ("decimal fraction", "fraction|as a fraction|decimal|ratio", "proportion", "", ""),
    ("percent", "%|pct|per cent", "1/100 decimal fraction", "", ""),
    ("per mille", "‰|per thousand", "1/1000 decimal fraction", "", ""),
    ("basis point", "bp", "1/10000 decimal fraction", "", ""),
]
PREFIXES = {"kilo": 1e3, "mega": 1e6, "giga": 1e9, "tera": 1e12, "centi": 1e-2, "milli": 1e-3, "micro": 1e-6}
SYMBOL_PREFIXES = {"k": "kilo", "m": "mega", "g": "giga", "t": "tera"}
SCALES = {"k": 1e3, "thsd": 1e3, "thousand": 1e3, "thousands": 1e3, "'000": 1e3, "000": 1e3, "m": 1e6, "mm": 1e6, "mn": 1e6, "mill": 1e6, "million": 1e6, "millions": 1e6, "bn": 1e9, "billion": 1e9, "billions": 1e9}
FILLER = {"in", "of", "pa", "amounts", "are", "figures", "all", "money", "columns", "note", "a"}
OPERATORS = {"/": -1, "per": -1, "*": 1, "·": 1, "×": 1}
POWERS = {"²": 2, "³": 3}

TOKEN = re.compile(r"'000|000\b|us\$|[$¢%‰]|°\s?[a-z]\b|(?<=[a-z])\^-?\d|(?<=[a-z])\d(?!\d)|[²³]|[/*·×]|[^\W\d_]+(?:[.-][^\W\d_]+)*")
DIGIT = "0-9" + "".join(MISREAD)
NUMBER = re.compile(rf"[{DIGIT}.,](?:[{DIGIT}.,]|[ \u00a0\u2009\u202f](?=(?=\D{{0,2}}\d)[{DIGIT}]{{3}}(?![^\W_])))*")
DATE = re.compile(r"\d{1,4}[/.-]\d{1,2}[/.-]\d{1,4}$")
NOTES = "*†‡§ \t\r\n\x0b\x0c\u00a0\u2009\u202f"
CELL = re.compile(rf"(?:([-−–+])\s*)?((?:US\s?\$|USD|US|\$|€|£)?)\s*(?:([-−–])\s*)?({NUMBER.pattern})")
HAS_DIGIT = re.compile(r"\d")
TRANSLATE = str.maketrans(MISREAD)
MONEY_NOTE = re.compile(r"(?:amounts?|figures|columns?)\b[^.()]*?\b(thousand|million|billion)s?\b|\bin\s+(thousand|million|billion)s?\s+of\s+dollars", re.I)
#: Texts whose reading a system keeps; it forgets all when there are more.
MOST_KEPT = 65_536


@dataclass(frozen=True)
class Unit:
    """A unit as an exponent vector over the bases of its system, a factor and an offset to the base units."""

    dims: tuple[int, ...]
    factor: float = 1.0
    offset: float = 0.0
    name: str = ""

    def times(self, other: Unit, power: int = 1) -> Unit:
        """Product with a power of another unit. An offset has a meaning only where a unit stands alone."""
        if power == 1 and not self.name and not any(self.dims):
            return replace(other, factor=self.factor * other.factor)
        name = f"{self.name} {other.name}^{power}".strip() if power != 1 else f"{self.name} {other.name}".strip()
        return Unit(tuple(a + power * b for a, b in zip(self.dims, other.dims)), self.factor * other.factor**power, 0.0, name)

    def scaled(self, scale: float) -> Unit:
        """So many of this unit as one: the number is multiplied before the offset is added."""
        return replace(self, factor=self.factor * scale)

    def common(self, number: float, to: Unit) -> float:
        """``number`` of this unit in the unit ``to`` of the same dimension."""
        return (number * self.factor + self.offset - to.offset) / to.factor


@dataclass(frozen=True)
class Stated:
    """What one place says of a unit: a scale factor, a unit, or both."""

    scale: float | None
    unit: Unit | None


@dataclass(frozen=True)
class Quantity:
    """A number in the common unit; ``assumed`` if it holds in a column of money only."""

    column: str
    quantity: str
    unit: str
    value: float
    common_unit: str
    assumed: bool


class UnitSystem:
    """The units of ``DEFINITIONS`` and of a catalogue of (quantity, unit_name, factor, offset, common_unit) rows.

    The offset of a row may be None: then the definitions give it. A name of the catalogue that no definition covers is a
    new unit of its common unit's dimension; a common unit that none covers has a new dimension of its own. A name
    without letters and signs, a factor that is null or zero, one that contradicts the name's scale word, and a unit of
    another dimension than its common unit raise ValueError, so no row of the catalogue is lost without notice.
    """

    def __init__(self, catalogue: Iterable[tuple] = ()):
        rows = [tuple(r) for r in catalogue]
        self._kept: dict = {}
        self._spelled: dict[str, Unit] = {}
        self._named: dict[str, Unit] = {}
        self._symbols: dict[str, tuple[Unit, str]] = {}
        self._longest = 1
        bases = list(BASES)
        self._bases = bases
        for name, spellings, size, offset, prefixes in DEFINITIONS:
            self._define(replace(self._size(size), name=name, offset=float(Fraction(offset)) if offset else 0.0), spellings.split("|"), prefixes)
        for common in dict.fromkeys(r[4] for r in rows):
            self._check_name(common)
            if self._whole(common) is None:
                bases.append(common)
                self._widen()
                self._define(Unit(tuple(int(b == common) for b in bases), 1.0, 0.0, common), [], "")
        self.quantities: dict[tuple[int, ...], tuple[str, Unit]] = {}
        self.money: Unit | None = None
        for quantity, name, factor, offset, common in rows:
            self._check_name(name)
            if not factor:
                raise ValueError(f"{name!r} of the unit catalogue has no factor")
            to, here = self._whole(common), self._whole(name)
            if here is not None and here.dims != to.dims:
                raise ValueError(f"{name!r} of the unit catalogue is of another dimension than {common!r}")
            scale = self._product(self._tokens(name))[0] if here is not None else None
            if scale is None:
                # value in common units = number * factor + offset, both sides in base units
                move = to.offset + offset * to.factor if offset is not None else here.offset if here is not None else to.offset
                self._define(Unit(to.dims, factor * to.factor, move, name), [], "")
            elif abs(here.factor / to.factor - factor) > 1e-6 * abs(factor):
                # a scale word and a known unit: the grammar reads it, and the catalogue may not say otherwise
                raise ValueError(f"{name!r} of the unit catalogue is not {scale:g} of its unit")
            if self.quantities.setdefault(to.dims, (quantity, replace(to, name=common)))[0] != quantity:
                raise ValueError(f"{quantity!r} and {self.quantities[to.dims][0]!r} of the unit catalogue have one dimension")
            if quantity == "money":
                self.money = replace(to, name=common)
        self._kept.clear()

    @staticmethod
    def _check_name(name: str | None) -> None:
        if not name or not TOKEN.findall(name.lower()):
            raise ValueError(f"{name!r} of the unit catalogue is no name of a unit")

    def _widen(self) -> None:
        pad = lambda u: replace(u, dims=u.dims + (0,) * (len(self._bases) - len(u.dims)))
        self._spelled = {k: pad(u) for k, u in self._spelled.items()}
        self._named = {k: pad(u) for k, u in self._named.items()}
        self._symbols = {k: (pad(u), p) for k, (u, p) in self._symbols.items()}
        self._kept.clear()

    def _define(self, unit: Unit, spellings: list[str], prefixes: str) -> None:
        phrase = " ".join(self._tokens(unit.name))
        same = self._spelled.get(phrase)
        if same is not None:  # the catalogue's word on a known unit holds for all its spellings
            self._spelled = {k: unit if u.name == same.name else u for k, u in self._spelled.items()}
            self._symbols = {k: (unit if u.name == same.name else u, p) for k, (u, p) in self._symbols.items()}
        self._named[phrase] = self._spelled[phrase] = unit
        for s in spellings:
            self._spelled[s] = unit
            if prefixes and " " not in s and s.isalpha():
                self._symbols[s] = (unit, prefixes)
        self._longest = max(self._longest, *(len(s.split()) for s in [phrase, *spellings]))
        self._kept.clear()

    def _size(self, text: str) -> Unit:
        """The unit that a definition's size says."""
        if text in self._bases:
            return Unit(tuple(int(b == text) for b in self._bases))
        m = re.match(r"([\d./]+) ", text)
        unit = self._product(self._tokens(text[m.end() :] if m else text))[1]
        return Unit(unit.dims, unit.factor * (float(Fraction(m[1])) if m else 1.0))

    def _whole(self, name: str) -> Unit | None:
        """The unit that a name of the catalogue stands for, scale words included."""
        got = self._product(self._tokens(name))
        return got[1].scaled(got[0] or 1.0) if got and got[1] is not None else None

    @staticmethod
    def _tokens(text: str) -> list[str]:
        low = text.lower().replace("b.p.", "bp").replace("p.a.", "pa").replace("per annum", "pa")
        words = [t for raw in TOKEN.findall(low) for t in (raw.replace(".", "").replace("-", " ").split() if raw[0].isalpha() else [raw.replace(" ", "")])]
        # a scale may stand right before a currency code: kUSD
        return [t for w in words for t in ([w[:-3], "usd"] if w.endswith("usd") and w[:-3] in SCALES else [w])]

    def _unit(self, phrase: str) -> Unit | None:
        """The unit of a name, spelling, plural or prefixed name."""
        singular = phrase[:-1] if len(phrase) > 2 and phrase.endswith("s") else phrase
        for s in (phrase, singular):
            if s in self._spelled:
                return self._spelled[s]
        for s in (phrase, singular):
            for prefix, factor in PREFIXES.items():
                if s.startswith(prefix) and (unit := self._spelled.get(s[len(prefix) :])) is not None:
                    return self._prefixed(prefix, factor, unit)
            unit, allowed = self._symbols.get(s[1:], (None, ""))
            if unit is not None and s[0] in allowed:
                prefix = SYMBOL_PREFIXES[s[0]]
                return self._prefixed(prefix, PREFIXES[prefix], unit)
        return None

    def _prefixed(self, prefix: str, factor: float, unit: Unit) -> Unit:
        name = prefix + unit.name
        return self._named.get(name.lower()) or replace(unit, factor=unit.factor * factor, name=name)

    def _product(self, tokens: list[str]) -> tuple[float | None, Unit | None] | None:
        """Scale and product of the units of an expression; None if a token is no part of one."""
        scale, unit, last, sign, i = None, None, None, 1, 0
        while i < len(tokens):
            t = tokens[i]
            for n in range(min(self._longest, len(tokens) - i), 0, -1):
                here = self._unit(" ".join(tokens[i : i + n]))
                if here is not None:
                    break
            if here is not None:
                i += n
                power = 1
                if i < len(tokens) and (tokens[i][0] == "^" or tokens[i] in POWERS or len(tokens[i]) == 1 and tokens[i].isdigit()):
                    power = POWERS.get(tokens[i]) or int(tokens[i].lstrip("^"))
                    i += 1
                # a unit that is said twice, as in "$5 USD", is said once
                if sign < 0 or power != 1 or here.name != last:
                    unit = (unit or Unit((0,) * len(self._bases))).times(here, sign * power)
                last, sign = here.name, 1
                continue
            if t in OPERATORS:
                sign = OPERATORS[t]
            elif t in SCALES:
                scale, sign = SCALES[t] ** sign * (scale or 1.0), 1
            elif t not in FILLER:
                return None
            i += 1
        return scale, unit

    def _keep(self, key: tuple, value: object) -> object:
        if len(self._kept) >= MOST_KEPT:
            self._kept.clear()
        self._kept[key] = value
        return value

    def parse_unit(self, text: str | None) -> Stated | None:
        """The unit expression ``text``; None if any of it is no part of a unit, or if the catalogue has no such quantity."""
        if not text:
            return None
        key = ("u", text)
        if key in self._kept:
            return self._kept[key]
        got = self._product(self._tokens(text))
        stated = None
        if got and (got[0] or got[1]) and (got[1] is None or got[1].dims in self.quantities):
            stated = Stated(*got)
        return self._keep(key, stated)

    def parse_quantity(self, raw: str | None) -> tuple[float, Stated | None] | None:
        """Number and stated unit of a cell text: ``[-(] [currency] number [scale] [unit] [)] [marks]``.

        None where the text is no quantity: blank, placeholder, rating, date, formula, name.
        """
        if not raw or raw.lstrip().startswith("="):
            return None
        text = raw.rstrip(NOTES).strip()
        sign = 1.0
        if text[:1] == "(" and text[-1:] == ")":
            sign, text = -1.0, text[1:-1].strip()
        m = CELL.match(text)
        if not m or not HAS_DIGIT.search(m[4]) or DATE.match(raw.rstrip(NOTES).strip()):
            return None
        if m[1] and m[1] != "+":
            sign = -sign
        if m[3]:
            sign = -sign
        before, value, after = m[2], parse_number(m[4]), text[m.end() :].strip()
        if value is None:
            return None
        stated = self.parse_unit(f"{before} {after}".strip())
        if stated is None and (before or after):
            return None
        return sign * value, stated

    def split_header(self, header: str | None) -> tuple[str, Stated | None]:
        """Name and stated unit of a column header: ``name (unit)`` or ``name in unit``."""
        if not header:
            return "", None
        key = ("h", header)
        if key in self._kept:
            return self._kept[key]
        for m in (re.search(r"^(.*?)\s*\(([^()]*)\)\s*$", header), re.search(r"^(.*?)\s+in\s+(.+)$", header)):
            if m and (stated := self.parse_unit(m[2])):
                return self._keep(key, (m[1].strip().lower(), stated))
        return self._keep(key, (header.strip().lower(), None))

    def money_note(self, text: str | None) -> float | None:
        """The scale that a caption or footnote states for the money columns of its table."""
        if not text or self.money is None:
            return None
        key = ("n", text)
        if key in self._kept:
            return self._kept[key]
        m = MONEY_NOTE.search(text)
        return self._keep(key, SCALES[(m[1] or m[2]).lower()] if m else None)

    def quantity(self, raw: str | None, units: str | None, header: str | None, notes: Iterable[str] | None) -> Quantity | None:
        """The quantity of a cell in its common unit; its text, units, header and, for money, notes complete each other.

        The first place that names a unit gives it. For money in the common unit the first place with a scale gives
        the scale; any other unit takes a scale only from a place that names the unit as well.
        """
        parsed = self.parse_quantity(raw)
        if parsed is None:
            return None
        number, column = parsed[0], self.split_header(header)
        places = [s for s in (parsed[1], self.parse_unit(units), column[1]) if s]
        unit = next((s.unit for s in places if s.unit), None)
        assumed = unit is None
        if assumed or self.money is not None and unit.name == self.money.name:
            note = next((x for t in (notes if notes is not None else ()) if (x := self.money_note(t))), None)
            if assumed and (self.money is None or not places and note is None):
                return None
            unit, scale = self.money, next((s.scale for s in places if s.scale), note)
        else:
            scale = next((s.scale for s in places if s.scale and s.unit and s.unit.name == unit.name), None)
        quantity, to = self.quantities[unit.dims]
        return Quantity(column[0], quantity, unit.name, unit.scaled(scale or 1.0).common(number, to), to.name, assumed)


def parse_number(body: str) -> float | None:
    """Digits with thousands and decimal marks; a single comma before three final digits groups thousands."""
    body = re.sub(r"[\s   ]", "", body.translate(TRANSLATE)).rstrip(".,")
    if "," not in body and body.replace(".", "", 1).isdigit():
        return float(body)
    commas, points = body.count(","), body.count(".")
    if commas and points:
        mark = max(body.rfind(","), body.rfind("."))
        if body.count(body[mark]) > 1:
            mark = len(body)
    elif commas == 1:
        mark = len(body) if re.search(r"\d,\d{3}$", body) else body.index(",")
    elif points == 1:
        mark = body.index(".")
    else:
        mark = len(body)
    whole, part = re.sub(r"[.,]", "", body[:mark]), re.sub(r"[.,]", "", body[mark:])
    if not (whole + part).isdigit():
        return None
    return float(f"{whole or 0}.{part or 0}")
