"""HTML fragments and URL parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def html_row(label: str | Column, value: str | Column) -> Column:
    """Table row of two cells."""
    return F.concat(
        F.lit("<tr><td> "), _text(label), F.lit(" </td><td> "), _text(value), F.lit(" </td></tr>")
    )


def html_table(columns: Sequence[str], sep: str = "\n") -> Column:
    """Table with a row for each named column that is not null."""
    rows = F.array_compact(F.array(*[html_row(F.lit(c), c) for c in columns]))
    return html_table_of(rows, sep)


def html_table_of(rows: Column, sep: str = "\n") -> Column:
    return F.concat(F.lit("<table><tbody>"), F.array_join(rows, sep), F.lit("</tbody></table>"))


def mention_link(otype: str, oid: str | Column, text: str | Column, route: str | None = None) -> Column:
    """Anchor to a catalog object."""
    route = route or f"/{otype}/"
    return F.concat(
        F.lit('<a data-oid="'), _text(oid), F.lit(f'" data-otype="{otype}" href="{route}'),
        _text(oid), F.lit('/">'), _text(text), F.lit("</a>"),
    )


def url_enc(value: str | Column) -> Column:
    """Percent encoding with %20 for a blank; the slash stays."""
    encoded = F.url_encode(_text(value))
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def url_dec(value: str | Column) -> Column:
    """Reverse of ``url_enc``; a plus sign is kept as it is."""
    return F.try_url_decode(F.replace(_text(value), F.lit("+"), F.lit("%2B")))


def url_part(value: str | Column, part: str = "PATH") -> Column:
    return F.try_parse_url(_text(value), F.lit(part))
