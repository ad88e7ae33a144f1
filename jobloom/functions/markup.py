"""HTML to plain text: tags out, character references decoded, blanks collapsed."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

from jobloom.functions.common import map_literal, text_or_empty

REPLACEMENT = "�"

# A reference (decimal, hexadecimal or named), a run without ampersand, or a lone ampersand.
_PIECES = r"(&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&)"
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def _names_by_initial() -> dict[str, dict[str, str]]:
    """The HTML5 name table split by first letter, to keep each map lookup short."""
    table: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        table.setdefault(name[0], {})[name] = text
    return table


def _code_point_overrides() -> dict[int, str]:
    """Code points that HTML5 reads as something else: NUL, CR and the Windows-1252 block."""
    table = {0x00: REPLACEMENT, 0x0D: "\r"}
    for code in range(0x80, 0xA0):
        table[code] = bytes([code]).decode("cp1252", errors="ignore") or chr(code)
    return table


def _is_dropped(code: Column) -> Column:
    """Control and non-character code points, which HTML5 decodes to nothing."""
    control = (
        code.between(0x01, 0x08) | (code == 0x0B) | code.between(0x0E, 0x1F) | code.between(0x7F, 0x9F)
    )
    non_character = code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return control | non_character


def _decode_number(piece: Column) -> Column:
    hexadecimal = F.lower(F.substring(piece, 3, 1)) == "x"
    digits = F.regexp_extract(piece, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    # More digits than any valid code point has would only overflow the conversion.
    code = (
        F.when(F.length(digits) > 7, F.lit(0x110000))
        .when(digits == "", F.lit(0))
        .when(hexadecimal, F.conv(digits, 16, 10).cast("int"))
        .otherwise(digits.cast("int"))
    )
    overrides = map_literal({str(k): v for k, v in _code_point_overrides().items()}, "map<string,string>")
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.coalesce(
        F.try_element_at(overrides, code.cast("string")),
        F.when(code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit(REPLACEMENT))
        .when(_is_dropped(code), F.lit(""))
        .otherwise(character),
    )


def _decode_name(piece: Column) -> Column:
    names = map_literal(_names_by_initial(), "map<string,map<string,string>>")
    # Old names may lack the semicolon and run into the next letters: longest one wins.
    old = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
    prefix = F.regexp_extract(piece, "^&(" + "|".join(old) + ")", 1)

    def lookup(name: Column) -> Column:
        return F.try_element_at(F.try_element_at(names, F.substring(name, 1, 1)), name)

    whole = lookup(piece.substr(F.lit(2), F.length(piece)))
    partial = F.when(
        prefix != "",
        F.concat(lookup(prefix), piece.substr(F.length(prefix) + 2, F.length(piece))),
    )
    return F.coalesce(whole, partial, piece)


def unescape(value: Column | str) -> Column:
    """Decode every HTML character reference."""
    pieces = F.regexp_extract_all(text_or_empty(value), F.lit(_PIECES), F.lit(1))

    def decode(piece: Column) -> Column:
        return (
            F.when(~piece.startswith("&") | (F.length(piece) == 1), piece)
            .when(piece.startswith("&#"), _decode_number(piece))
            .otherwise(_decode_name(piece))
        )

    return F.array_join(F.transform(pieces, decode), "")


def strip_html(value: Column | str) -> Column:
    """Plain text of an HTML fragment; null becomes the empty string.

    References are decoded after the tags are gone, so `&lt;b&gt;` stays as the
    text `<b>`. Script and style bodies are kept.
    """
    untagged = F.regexp_replace(text_or_empty(value), r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(unescape(untagged), _BLANKS, " "))
