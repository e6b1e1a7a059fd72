"""HTML character references decoded with Catalyst expressions only.

The text is cut at every ``&``. Each piece after the first starts with what may
be a reference, so a piece is decoded on its own and the pieces are joined
again: one pass, and a decoded ``&`` is never looked at twice.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

# Windows-1252 stands in for the C1 control range.
_C1_RANGE = range(0x80, 0xA0)
_REPLACEMENT = "\ufffd"
_LARGEST_CODE_POINT = 0x10FFFF

_NUMERIC = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
_NAMED = "^[^\\t\\n\\f <&#;]{1,32};?"


# The handful that make up nearly all references in practice, looked at first.
_COMMON = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "nbsp;": "\u00a0"}


def _is_common(piece: Column) -> Column:
    found = F.lit(False)
    for name in _COMMON:
        found = found | piece.startswith(name)
    return found


def _c1_characters() -> list[str]:
    out = []
    for code in _C1_RANGE:
        try:
            out.append(bytes([code]).decode("cp1252"))
        except UnicodeDecodeError:
            out.append(chr(code))
    return out


def _names_by_initial() -> str:
    """Names that need a closing ``;``, grouped by first letter to keep lookups short."""
    groups: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        if name.endswith(";"):
            groups.setdefault(name[0], {})[name[:-1]] = text
    return json.dumps(groups, ensure_ascii=False)


def _legacy_names() -> dict[str, str]:
    """Names that are also honoured without ``;`` and as a prefix of a longer word."""
    return {name: text for name, text in html5.items() if not name.endswith(";")}


def _code_point(piece: Column) -> Column:
    decimal = F.regexp_extract(piece, "^#0*([0-9]+)", 1)
    hexadecimal = F.regexp_extract(piece, "^#[xX]0*([0-9a-fA-F]+)", 1)
    too_large = F.lit(_LARGEST_CODE_POINT + 1)
    return (
        F.when(F.length(hexadecimal) > 8, too_large)
        .when(hexadecimal != "", F.conv(hexadecimal, 16, 10).try_cast("bigint"))
        .when(F.length(decimal) > 10, too_large)
        .otherwise(decimal.try_cast("bigint"))
    )


def _character(code: Column) -> Column:
    utf32 = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    c1 = F.array(*[F.lit(c) for c in _c1_characters()])
    dropped = (
        code.between(0x1, 0x8)
        | (code == 0xB)
        | code.between(0xE, 0x1F)
        | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF)
        | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    return (
        F.when((code == 0) | (code > _LARGEST_CODE_POINT) | code.between(0xD800, 0xDFFF), _REPLACEMENT)
        .when(code.between(_C1_RANGE.start, _C1_RANGE.stop - 1),
              F.try_element_at(c1, (code - (_C1_RANGE.start - 1)).cast("int")))
        .when(dropped, "")
        .otherwise(utf32)
    )


def _decode_piece(piece: Column) -> Column:
    names = F.from_json(F.lit(_names_by_initial()), "map<string,map<string,string>>")
    legacy = _legacy_names()
    legacy_map = F.from_json(F.lit(json.dumps(legacy, ensure_ascii=False)), "map<string,string>")
    legacy_pattern = "^(?:" + "|".join(sorted(legacy, key=lambda n: (-len(n), n))) + ")"

    text = piece["text"]
    numeric, named = piece["numeric"], piece["named"]
    bare = F.regexp_replace(named, ";$", "")
    full = F.when(
        named.endswith(";"),
        F.try_element_at(F.try_element_at(names, F.substring(bare, 1, 1)), bare),
    )
    prefix = F.regexp_extract(named, legacy_pattern, 0)

    def after(matched: Column) -> Column:
        return F.substr(text, F.length(matched) + 1)

    common = F.when(F.lit(False), F.lit(""))
    for name, char in _COMMON.items():
        common = common.when(text.startswith(name), F.concat(F.lit(char), F.substr(text, F.lit(len(name) + 1))))
    return (
        common
        .when(numeric != "", F.concat(_character(piece["code"]), after(numeric)))
        .when(full.isNotNull(), F.concat(full, after(named)))
        .when(prefix != "", F.concat(F.try_element_at(legacy_map, prefix), after(prefix)))
        .otherwise(F.concat(F.lit("&"), text))
    )


def decode_entities(c: Column) -> Column:
    """Named, decimal and hexadecimal character references -> characters."""
    pieces = F.split(c, "&")
    tail = F.slice(pieces, F.lit(2), F.size(pieces))
    parsed = F.transform(
        tail,
        lambda s: F.struct(
            s.alias("text"),
            F.when(s.startswith("#"), F.regexp_extract(s, _NUMERIC, 0)).otherwise("").alias("numeric"),
            F.when(s.startswith("#"), _code_point(s)).alias("code"),
            F.when(s.startswith("#") | _is_common(s), "").otherwise(F.regexp_extract(s, _NAMED, 0)).alias("named"),
        ),
    )
    decoded = F.concat(F.get(pieces, 0), F.array_join(F.transform(parsed, _decode_piece), ""))
    return F.when(c.contains("&"), decoded).otherwise(c)
