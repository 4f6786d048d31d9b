"""Identifier slugs as native string expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import INVALID_SLUG


@lru_cache(maxsize=1)
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """ASCII residue of every character's NFKD form, split into 1:1 and 1:n."""
    single, several = {}, {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        form = unicodedata.normalize("NFKD", char)
        if form == char:
            continue
        residue = "".join(c for c in form if c < "\x80")
        if len(residue) == 1:
            single[char] = residue
        elif residue:
            several[char] = residue
    return single, several


def _char_class(chars) -> str:
    """Regex class of the characters, as few ranges as possible."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in ranges) + "]"


def _spell_out(text: Column) -> Column:
    """Replace 1:n compatibility characters (ligatures, fractions, ...); the text between them is taken as it is."""
    _, several = _ascii_folds()
    folds = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    found, plain = F.regexp_extract_all(text, F.lit(_char_class(several)), F.lit(0)), F.split(text, _char_class(several), -1)
    return F.array_join(F.zip_with(plain, found, lambda before, ch: F.concat(before, F.coalesce(folds[ch], F.lit("")))), "")


def fold_ascii(text: Column) -> Column:
    """Compatibility-decompose and keep the ASCII part only."""
    single, several = _ascii_folds()
    text = F.when(text.rlike(_char_class(several)), _spell_out(text)).otherwise(text)
    text = F.translate(text, "".join(single), "".join(single.values()))
    return F.regexp_replace(text, r"[^\x00-\x7F]+", "")


def normalize_name(name: Column) -> Column:
    """Lower-case ASCII identifier of a display name; NULL gives ''."""
    lowered = F.lower(name)
    # Plain ASCII names, nearly all of them, skip the folding tables.
    ascii_text = F.when(lowered.rlike(r"[^\x00-\x7F]"), fold_ascii(lowered)).otherwise(lowered)
    slug = F.btrim(F.regexp_replace(ascii_text, "[^A-Za-z0-9]+", "_"), F.lit("_"))
    slug = F.regexp_replace(F.regexp_replace(slug, "^([0-9])", "_$1"), "^$", INVALID_SLUG)
    return F.coalesce(slug, F.lit(""))
