"""String and list-literal column functions (SCL1-SCL9).

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; nothing here calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace),
# written as a regex character class shared with the SQL oracle.
WHITESPACE_CLASS = (
    "[\\t\\n\\x0b\\x0c\\r \\x1c\\x1d\\x1e\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)

# Full case folds (str.casefold) that differ from lower(),
# for the letters likely in names: sharp s, capital sharp s, long s,
# final sigma.
CASEFOLD_EXTRA = [("ß", "ss"), ("ẞ", "ss"), ("ſ", "s"), ("ς", "σ")]

# Fixed value: the text pandas' astype(str) gives a missing value.
MISSING_TEXT = "nan"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL (pandas treats NaN as missing; Spark does not)."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))


def trim_ws(c) -> Column:
    """Python ``str.strip()``: removes all leading/trailing whitespace, not
    only spaces as Spark ``trim`` does."""
    cls = WHITESPACE_CLASS
    return F.regexp_replace(col_(c), f"^{cls}+|{cls}+$", "")


def casefold(c) -> Column:
    """``str.casefold()`` approximated as lower() plus the fixed full folds."""
    out = F.lower(col_(c))
    for src, dst in CASEFOLD_EXTRA:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def as_text(c, parity: bool = False) -> Column:
    """``astype(str)``: with ``parity`` a NULL becomes the text 'nan' (as
    pandas does); by default NULL stays NULL."""
    s = col_(c).cast("string")
    return F.coalesce(s, F.lit(MISSING_TEXT)) if parity else s


def normalise_key(c, parity: bool = False) -> Column:
    """Join key for names: astype(str) -> strip -> lower."""
    return F.lower(trim_ws(as_text(c, parity)))


_JSON_OPTS = {"allowBackslashEscapingAnyCharacter": "true"}
# one item of a literal: a quoted text, None, or a bare name or number
_QUOTED = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
_ITEM = rf"(?:{_QUOTED}|[A-Za-z0-9_.+-]++)"
_LITERAL = rf"(?s)\s*(?:\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*+,?\s*)?\]|\(\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*+,?\s*)?\))\s*"


def _unescape(body: Column) -> Column:
    """The text between the quotes of a literal: backslash escapes as in
    Python (``\x41`` as JSON writes it, inner double quotes protected)."""
    json = F.regexp_replace(body, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    json = F.regexp_replace(json, r"(?<!\\)((?:\\\\)*)\"", r'$1\\"')
    # a raw line break or tab cannot stand in JSON text
    for raw, name in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        json = F.replace(json, F.lit(raw), F.lit(name))
    read = F.from_json(F.concat(F.lit('["'), json, F.lit('"]')), "array<string>", _JSON_OPTS)
    return F.when(F.contains(body, F.lit("\\")), F.get(read, F.lit(0))).otherwise(body)


def parse_list(c) -> Column:
    """Strict list-literal parse (``ast.literal_eval`` on ``"['a', 'b']"`` or
    ``"('a', 'b')"``) into ARRAY<STRING>.  Unparseable text gives NULL; a
    ``None`` item is kept as NULL inside the array, numbers as their text."""
    c = col_(c)
    quoted = lambda x: x.startswith("'") | x.startswith('"')
    item = lambda x: (F.when(quoted(x), _unescape(F.substring(x, F.lit(2), F.length(x) - 2)))
                      .when(x != "None", x))
    items = F.transform(F.regexp_extract_all(c, F.lit(f"(?s){_ITEM}"), F.lit(0)), item)
    return F.when(F.regexp_like(c, F.lit(f"^{_LITERAL}$".replace("^(?s)", "(?s)^"))), items)


def parse_list_strict(c) -> Column:
    """As ``parse_list`` but fails the job on text that is not a list
    literal, as ``ast.literal_eval`` raises."""
    c = col_(c)
    parsed = parse_list(c)
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("not a list literal: "), c))).otherwise(parsed)


def items_of(c) -> Column:
    """Items of a column of list literals or plain texts: text that begins
    like a list is parsed strictly, any other text is its only item."""
    c = col_(c)
    return F.when(trim_ws(c).rlike(r"^[\[(]"), parse_list_strict(c)).when(c.isNotNull(), F.array(c.cast("string")))


def parse_list_tolerant(c, parity: bool = False) -> Column:
    """``to_list_if_str`` + "ensure list": text starting with '[' is parsed,
    broken text becomes a one-item list of itself, any other value becomes
    ``[str(value)]``.  NULL gives NULL (``['nan']`` under ``parity``)."""
    c = col_(c)
    wrapped = F.array(c.cast("string"))
    parsed = F.when(trim_ws(c).startswith("["), F.coalesce(parse_list(c), wrapped)).otherwise(wrapped)
    if parity:
        return F.when(c.isNull(), F.array(F.lit(MISSING_TEXT))).otherwise(parsed)
    return F.when(c.isNull(), F.lit(None).cast("array<string>")).otherwise(parsed)


def clean_items(arr) -> Column:
    """``[str(x).strip() for x in lst if str(x).strip() != '']``; a NULL
    item prints as 'None' in Python, so it is kept as that text."""
    a = col_(arr)
    stripped = F.transform(a, lambda x: trim_ws(F.coalesce(x, F.lit("None"))))
    return F.filter(stripped, lambda x: x != F.lit(""))


def list_column(c, parity: bool = False) -> Column:
    """Tolerant parse then clean: the form the feature stage works on."""
    return clean_items(parse_list_tolerant(c, parity))
