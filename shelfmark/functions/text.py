"""Text matching, cleaning and labelling."""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def match_modes(column: str | Column, value: str, mode: str = "exact") -> Column:
    """Predicate for one of the search modes of the catalog API."""
    col = F.col(column) if isinstance(column, str) else column
    if mode == "exact":
        return col == value
    if mode == "iexact":
        return F.lower(col) == value.lower()
    if mode == "contains":
        return F.contains(F.lower(col), F.lit(value.lower()))
    if mode == "startswith":
        return col.startswith(value)
    if mode == "glob":
        return F.lower(col).like(
            value.lower().replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
            .replace("*", "%").replace("?", "_")
        )
    raise ValueError(f"unknown match mode {mode!r}")


def tokens(column: str | Column) -> Column:
    """Lower-case words of a text."""
    return F.array_remove(F.split(F.lower(column), r"[\W]+"), "")


def regex_map(column: str | Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Value of the first rule whose pattern is found (case ignored), else the text itself."""
    col = F.col(column) if isinstance(column, str) else column
    chain = F
    for pattern, value in rules:
        chain = chain.when(col.rlike("(?i)" + pattern), F.lit(value))
    return chain.otherwise(col)


def regex_extract(column: str | Column, pattern: str, group: int = 0) -> Column:
    """All matches of one group, in order."""
    return F.regexp_extract_all(column, F.lit(pattern), F.lit(group))


# white space, with the no-break and typographic blanks that \s does not cover
BLANK = r"[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]"


def text_clean(column: str | Column) -> Column:
    """Fold the odd double blanks used after a full stop, and make curly apostrophes straight.

    A pair of blanks seen between a full stop and a letter is folded wherever it occurs.
    """
    col = F.col(column) if isinstance(column, str) else column
    pairs = F.array_distinct(
        F.regexp_extract_all(col, F.lit(r"[.]+(" + BLANK + r"{2})[a-zA-Z]+"), F.lit(1))
    )
    folded = F.aggregate(pairs, col, lambda text, pair: F.replace(text, pair, F.lit(" ")))
    return F.translate(folded, "’", "'")


def matches(text: str | Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def rejoin(text: str | Column, pattern: str, replacements: Column) -> Column:
    """The text with its matches replaced one by one; all else is kept to the byte."""
    return F.array_join(
        F.flatten(
            F.zip_with(
                F.split(text, pattern, -1),
                replacements,
                lambda kept, new: F.array(kept, F.coalesce(new, F.lit(""))),
            )
        ),
        "",
    )


_MARK, _ESCAPE = "\u0001", "\u0002"


def pieces(text: str | Column, pattern: str) -> Column:
    """The text cut at the matches of a pattern, in one pass of it: places 0, 2, ... hold what is
    kept and 1, 3, ... the matches. Joined they are the text to the byte.
    """
    col = F.col(text) if isinstance(text, str) else text
    marked = F.contains(col, F.lit(_MARK)) | F.contains(col, F.lit(_ESCAPE))
    escaped = F.replace(F.replace(col, F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_MARK), F.lit(_ESCAPE + "a"))
    plain = F.when(marked, escaped).otherwise(col)
    cut = F.split(F.regexp_replace(plain, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)
    restored = lambda p: F.replace(F.replace(p, F.lit(_ESCAPE + "a"), F.lit(_MARK)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE))
    return F.transform(cut, lambda p: F.when(F.contains(p, F.lit(_ESCAPE)), restored(p)).otherwise(p))


def even_pieces(cut: str | Column) -> Column:
    """What is kept among ``pieces``: one more than there are matches."""
    return F.filter(cut, lambda _, i: i % 2 == 0)


def odd_pieces(cut: str | Column) -> Column:
    """The matches among ``pieces``."""
    return F.filter(cut, lambda _, i: i % 2 == 1)


ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# names of the HTML standard; those without a semicolon also stand before other letters
_NAMES = dict(html5)
_OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _code_table() -> dict[str, str]:
    """What numbers stand for that are no character of their own: those of the C1 block are read
    as Windows-1252, as browsers do, control characters and non-characters vanish.
    """
    table = {0: "\ufffd"}
    for n in range(0x80, 0xA0):
        table[n] = bytes([n]).decode("cp1252", "ignore") or chr(n)
    gone = [*range(1, 9), 0xB, *range(0xE, 0x20), 0x7F, *range(0xFDD0, 0xFDF0)]
    gone += [plane << 16 | low for plane in range(17) for low in (0xFFFE, 0xFFFF)]
    return {str(k): v for k, v in (table | dict.fromkeys(gone, "")).items()}


_SLOTS = 1024
_ENTRY, _VALUE, _NONE = "\u0001", "\u0002", "\u0003"


def _lookup(table: dict[str, str], name: Column) -> Column:
    """Value of ``name`` in a literal table, null if it has none.

    Spark looks through a map entry by entry, so the entries are dealt by a hash to slots of about
    two, each one text; the slots are folded into one constant before the query runs.
    """
    slots = [""] * _SLOTS
    for key, value in table.items():
        slots[crc32(key.encode()) % _SLOTS] += f"{_ENTRY}{key}{_VALUE}{value}"
    number = (F.crc32(name.cast("binary")) % _SLOTS).cast("int")
    slot = F.get(F.from_json(F.lit(json.dumps(slots)), T.ArrayType(T.StringType())), number)
    entry = F.concat(F.lit(_ENTRY), name, F.lit(_VALUE))
    # what follows the entry, or the mark behind the one put at the end; the slot is named only once
    rest = F.split_part(F.concat(slot, entry, F.lit(_NONE)), entry, F.lit(2))
    value = F.substring_index(rest, _ENTRY, 1)
    return F.get(F.filter(F.array(value), lambda v: v != _NONE), F.lit(0))


def _number(code: Column) -> Column:
    """Character of a code point given as a number."""
    in_range = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    wide = F.unhex(F.lpad(F.hex(F.when(in_range, code).otherwise(F.lit(0xFFFD).cast("bigint"))), 8, "0"))
    return F.coalesce(_lookup(_code_table(), code.cast("string")), F.decode(wide, "UTF-32"))


def _digits(text: Column, base: int) -> Column:
    """Number of a text of digits; beyond every code point if it is too long."""
    plain = F.regexp_replace(text, "^0+(?=.)", "")
    return F.when(F.length(plain) > 8, F.lit(1 << 31)).otherwise(F.conv(plain, base, 10).cast("bigint"))


def _numbered(entity: Column) -> Column:
    decimal = F.regexp_extract(entity, "^&#([0-9]+)", 1)
    hexadecimal = F.regexp_extract(entity, "^&#[xX]([0-9a-fA-F]+)", 1)
    return F.when(decimal != "", _number(_digits(decimal, 10))).when(
        hexadecimal != "", _number(_digits(hexadecimal, 16))
    )


def _resolved(entity: Column) -> Column:
    """Names are looked up whole first; only what is unknown is searched for a name it begins with."""
    name = F.substr(entity, F.lit(2))
    opened = F.regexp_extract(name, "^(?:" + "|".join(_OPEN_NAMES) + ")", 0)
    by_start = F.concat(_lookup(_NAMES, opened), F.substr(name, F.length(opened) + 1))
    by_name = F.coalesce(_lookup(_NAMES, name), F.when(opened != "", by_start))
    return F.coalesce(F.when(F.startswith(name, F.lit("#")), _numbered(entity)).otherwise(by_name), entity)


def html_unescape(column: str | Column) -> Column:
    """Resolve named and numeric HTML entities, each once: ``&amp;lt;`` becomes ``&lt;``."""
    col = F.col(column) if isinstance(column, str) else column
    resolved = rejoin(col, ENTITY, F.transform(matches(col, ENTITY), _resolved))
    return F.when(F.contains(col, F.lit("&")), resolved).otherwise(col)


def truncate_label(column: str | Column, n: int = 25, prefix: str = "") -> Column:
    return F.substring(F.concat(F.lit(prefix), column), 1, n)


def seq_label(number: str | Column, width: int = 4) -> Column:
    """Number with leading zeros; longer numbers stay whole."""
    text = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def substr_after(column: str | Column, sep: str) -> Column:
    """Text after the first ``sep``; the whole text without one."""
    col = F.col(column) if isinstance(column, str) else column
    at = F.position(F.lit(sep), col)
    return F.when(at > 0, F.substr(col, at + len(sep))).otherwise(col)
