"""Text normalisation. What a column expression can decide stays in the JVM: strings of characters that NFKC and case
folding treat simply (``SIMPLE``). Only the others go to Python's tables, by an Arrow function, each once a row. The
``exact=False`` forms take every string as a simple one; they agree with the exact ones on ASCII input."""

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType

# Relation phrases and their canonical names; the first that a text contains decides.
RELATIONS = (
    ("装备", "equipped_with"),
    ("携带", "equipped_with"),
    ("配备", "equipped_with"),
    ("使用", "equipped_with"),
    ("属于", "belongs_to"),
    ("为", "belongs_to"),
    ("为...型", "belongs_to"),
    ("改装自", "modified_from"),
    ("基于", "modified_from"),
    ("包含", "contains"),
    ("设有", "contains"),
    ("位于", "located_in"),
    ("继承自", "inherited_from"),
)
_DASHES = str.maketrans("－—–", "---")
#: The line boundaries of Python's splitlines, and Unicode white space, as Java patterns.
LINE_END = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85  ]"
_SPACE = r"[\s\x1C-\x1F\x85\p{Z}]"
_NO_SPACE = r"[^\s\x1C-\x1F\x85\p{Z}]"
_ASCII_SPACE = re.compile(r"[\s\x1C-\x1F]+", re.ASCII)
#: Between strings, between lists, for an empty list and for none: no simple string has them.
_NEXT, _LIST, _EMPTY_LIST, _NO_LIST = "\x01", "\x02", "\x03", "\x04"
#: Strings that NFKC leaves as they are, now and together with any neighbours, and of which ``lower`` is the case folding:
#: ASCII but for the marks by which a row's strings are joined, the letters of Latin-1 without the sharp s, Russian letters,
#: dashes, kana and ideographs.
SIMPLE = r"^[\x00\x05-\x7F\u00C0-\u00D6\u00D8-\u00DE\u00E0-\u00F6\u00F8-\u00FF\u0410-\u044F\u2013\u2014\u3001\u3002\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FFF]*+\z"


def plain(value: str | None) -> str:
    """NFKC, then stripped."""
    return unicodedata.normalize("NFKC", value or "").strip()


def folded(value: str | None) -> str:
    """The comparison form: NFKC, no white space, one kind of dash, case folded."""
    return "".join(unicodedata.normalize("NFKC", value or "").split()).translate(_DASHES).casefold()


def relation_name(value: str | None) -> str:
    text = plain(value)
    return next((name for phrase, name in RELATIONS if phrase in text), None) or folded(text)


def ascii_folded(value: str | None) -> str:
    """The comparison form of a string that is taken as a simple one."""
    return _ASCII_SPACE.sub("", value or "").lower()


def ascii_relation_name(value: str | None) -> str:
    return next((name for phrase, name in RELATIONS if phrase in (value or "")), None) or ascii_folded(value)


def _arrays(fn, values: pd.Series) -> pd.Series:
    """Each list with ``fn`` of its elements after it."""
    known: dict[str | None, str] = {}

    def one(x):
        if x not in known:
            known[x] = fn(x)
        return known[x]

    return values.map(lambda v: None if v is None else [*v, *map(one, v)])


@F.pandas_udf(ArrayType(StringType()))
def _folded_arrays(values: pd.Series) -> pd.Series:
    return _arrays(folded, values)


@F.pandas_udf(ArrayType(StringType()))
def _plain_arrays(values: pd.Series) -> pd.Series:
    return _arrays(plain, values)


@F.pandas_udf(ArrayType(StringType()))
def _relation_arrays(values: pd.Series) -> pd.Series:
    return _arrays(relation_name, values)


def trim(col: Column) -> Column:
    """Unicode white space off both ends."""
    # one match from the first to the last other character; looking for white space at the end tries all that there is
    return F.regexp_extract(col, f"(?s)^{_SPACE}*+(.*{_NO_SPACE})", 1)


def is_blank(col: Column) -> Column:
    """Whether a string is empty or all white space: as ``trim(col) == ""``, but mostly one character is looked at."""
    return ~col.rlike(_NO_SPACE)


def _ascii_folded(x: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), r"[\s\x1C-\x1F]+", ""))


def _simple_folded(x: Column) -> Column:
    hyphens = F.replace(F.replace(x, F.lit("—"), F.lit("-")), F.lit("–"), F.lit("-"))
    return F.lower(F.regexp_replace(hyphens, r"[\s\x1C-\x1F]+", ""))


def _simple_trimmed(text: Column) -> Column:
    """White space off both ends of each of the joined strings."""
    return F.regexp_replace(text, f"(?<![^{_NEXT}{_LIST}])[\\s\\x1C-\\x1F]++|[\\s\\x1C-\\x1F]++(?![^{_NEXT}{_LIST}])", "")


def _relation_or(text: Column, otherwise: Column) -> Column:
    found = F.when(F.contains(text, F.lit(RELATIONS[0][0])), RELATIONS[0][1])
    for phrase, name in RELATIONS[1:]:
        found = found.when(F.contains(text, F.lit(phrase)), name)
    return found.otherwise(otherwise)


# Else the optimizer may put one such call into the arguments of another, of which it then evaluates only the inner one.
_folded_arrays, _plain_arrays, _relation_arrays = (f.asNondeterministic() for f in (_folded_arrays, _plain_arrays, _relation_arrays))


def is_simple(x: Column) -> Column:
    """Whether a string needs no table of Unicode's: all its characters are of SIMPLE."""
    return x.rlike(SIMPLE)


def _joined(values: Column) -> Column:
    """An array of arrays of strings as one string; null strings are empty."""
    one = lambda v: F.coalesce(F.when(F.size(v) > 0, F.array_join(v, _NEXT, "")), F.when(v.isNull(), _NO_LIST), F.lit(_EMPTY_LIST))
    return F.array_join(F.transform(values, one), _LIST)


def _parted(text: Column) -> Column:
    """What ``_joined`` joined; not for an empty string, which may stand for no list or for one of an empty string."""
    plainly = lambda t: F.when(t == _EMPTY_LIST, F.array().cast("array<string>")).when(t != _NO_LIST, F.split(t, _NEXT, -1))
    return F.transform(F.split(text, _LIST, -1), plainly)


def _hybrid(values: Column, simple, others, whole=None) -> Column:
    """An array of arrays of strings, with ``simple`` (a column function) applied to each simple string in place and
    ``others`` (a Python function of a list) to a row's distinct strings that are not, which are none in most rows. Where
    there are none, ``whole`` does the same to all strings at once, joined by marks that it leaves as they are."""
    strings = F.flatten(F.filter(values, lambda v: v.isNotNull()))
    none = F.array().cast("array<string>")
    # one look at all of a row's characters tells most rows, which then have nothing for Python
    odd = F.when(is_simple(F.array_join(strings, "")), none).otherwise(F.array_distinct(F.filter(strings, lambda x: x.isNotNull() & ~is_simple(x))))
    # the odd strings come back with their forms after them, so that they are not looked for once more
    told = others(odd)
    plainly = lambda x: simple(F.coalesce(x, F.lit("")))

    def one(x: Column, told: Column) -> Column:
        at = F.array_position(told, x)
        n = F.size(told) / 2
        return F.when((F.coalesce(at, F.lit(0)) == 0) | (at > n), plainly(x)).otherwise(F.get(told, (at - 1 + n).cast("int")))

    # each struct is an array's one element, so that it is computed once a row
    def singly(told: Column) -> Column:
        each = lambda y: F.transform(y["values"], lambda v: F.transform(v, lambda x: one(x, y["told"])))
        return F.get(F.transform(F.array(F.struct(values.alias("values"), told.alias("told"))), each), F.lit(0))

    def row(y: Column) -> Column:
        if whole is None:
            return F.when(F.coalesce(F.size(y["told"]), F.lit(0)) > 0, singly(y["told"])).otherwise(F.transform(values, lambda v: F.transform(v, plainly)))
        return F.when((F.coalesce(F.size(y["told"]), F.lit(0)) > 0) | (y["text"] == ""), singly(y["told"])).otherwise(_parted(whole(y["text"])))

    text = F.lit("") if whole is None else _joined(values)
    return F.get(F.transform(F.array(F.struct(text.alias("text"), told.alias("told"))), row), F.lit(0))


def fold_lists(values: Column, exact: bool = True) -> Column:
    """The comparison forms of an array of arrays of strings."""
    return _hybrid(values, _simple_folded, _folded_arrays, _simple_folded) if exact else F.transform(values, lambda v: F.transform(v, _ascii_folded))


def plain_lists(values: Column, exact: bool = True) -> Column:
    """NFKC and trimmed, of an array of arrays of strings."""
    return _hybrid(values, trim, _plain_arrays, _simple_trimmed) if exact else F.transform(values, lambda v: F.transform(v, lambda x: trim(F.coalesce(x, F.lit("")))))


def relation_lists(values: Column, exact: bool = True) -> Column:
    """Canonical relation names of an array of arrays of phrases."""
    named = lambda fold: lambda x: _relation_or(x, fold(x))
    return _hybrid(values, named(_simple_folded), _relation_arrays) if exact else F.transform(values, lambda v: F.transform(v, named(_ascii_folded)))


def _one_list(of_lists):
    return lambda values, exact: F.get(of_lists(F.array(values), exact), F.lit(0))


def fold_all(values: Column, exact: bool = True) -> Column:
    """The comparison forms of an array of strings."""
    return _one_list(fold_lists)(values, exact)


def plain_all(values: Column, exact: bool = True) -> Column:
    return _one_list(plain_lists)(values, exact)


def relation_all(values: Column, exact: bool = True) -> Column:
    """Canonical relation names of an array of phrases."""
    return _one_list(relation_lists)(values, exact)


def normalize_text(col: Column, exact: bool = True) -> Column:
    return F.element_at(fold_all(F.array(col), exact), 1)


def normalize_relation(col: Column, exact: bool = True) -> Column:
    return F.element_at(relation_all(F.array(col), exact), 1)


def split_lines(text: Column) -> Column:
    """Lines as Python's splitlines has them: no empty line after a final line end."""
    lines = F.split(text, LINE_END)
    whole = F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(whole)


def _tag(pattern: str) -> str:
    return "(?iU)" + pattern


def _marker(*parts: str) -> str:
    """A line of parts, with any white space around each."""
    return r"^\s*" + r"\s*".join(parts) + r"\s*$"


# The words, the unit and the marks of page markers and headings.
_PAGE, _NTH, _PAGE_NO, _UNIT = "page", "第", "页码", "页"
_HASHES, _RULE, _COLON, _DIGITS = "#{1,6}", "[-_*]{0,3}", "[:：]?", r"(\d+)"

#: The forms of a line that names a page by its one group of digits; the first that fits counts.
PAGE_PATTERNS = (
    _marker("(?:<!--)?", f"(?:{_PAGE}|{_PAGE_NO}|{_NTH})", _COLON, _DIGITS, f"{_UNIT}?", "(?:-->)?"),  # a label, also as a comment
    _marker(_RULE, f"{_NTH}?", _DIGITS, _UNIT, _RULE),  # a number with its unit, also within a rule
    _marker(_HASHES, f"(?:{_PAGE}|{_NTH})", _COLON, _DIGITS, f"{_UNIT}?"),  # a heading
)
#: The hashes of a heading line and its title, which may end in white space.
HEADING_PATTERN = rf"^({_HASHES})\s+(.+)$"


def page_hint(line: Column) -> Column:
    """The page a marker line names, else null."""
    return F.coalesce(*(F.nullif(F.regexp_extract(line, _tag(p), 1), F.lit("")) for p in PAGE_PATTERNS))


def heading_level(line: Column) -> Column:
    """1 to 6 for a heading line, else 0."""
    return F.length(F.regexp_extract(line, "(?U)" + HEADING_PATTERN, 1))


def heading_title(line: Column) -> Column:
    return trim(F.regexp_extract(line, "(?U)" + HEADING_PATTERN, 2))


def answer_lines(text: Column) -> Column:
    """An answer's lines, trimmed, without blank ones."""
    return F.filter(F.transform(split_lines(text), trim), lambda x: x != "")
