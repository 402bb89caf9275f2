"""String column functions: names, slugs, identifiers, locale numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accented letters and their plain forms
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"

# fixed values: display replacements, applied in this order
PUBLICATION_NAMES = {
    "11001": "Bogotá",
    "colombia": "Colombia",
    "italy": "Italia",
    "brazil": "Brasil",
    "peru": "Perú",
    " Usa": " EEUU",
    " Us": " EEUU",
    "Bogotá D.C.-Bogotá d C.": "Bogotá",
    "-": " - ",
}

# fixed values: singular and plural display name of each way to group areas
METHOD_LABELS = {
    "radial": ("Radial", "Radiales"),
    "geometry": ("Adminsitrativa", "Administrativas"),
    "community": ("Funcional", "Funcionales"),
}


def fold_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    return F.replace(F.initcap(F.regexp_replace(c, r"([^\p{L}])", "$1\u0001 ")), F.lit("\u0001 "), F.lit(""))


def replace_all(c: Column, table: dict[str, str]) -> Column:
    """Literal replacements in the order of the table."""
    for old, new in table.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def slug(c: Column) -> Column:
    """Folder-safe name: no accents, lower case, cut at the first '-', ':' or '_'."""
    c = F.replace(F.lower(fold_accents(c)), F.lit("."), F.lit(""))
    for mark in ("-", ":", "_"):
        c = F.substring_index(c, mark, 1)
    c = F.replace(F.replace(F.trim(c), F.lit("   "), F.lit(" ")), F.lit("  "), F.lit(" "))
    return F.replace(c, F.lit(" "), F.lit("_"))


def publication_name(c: Column) -> Column:
    return replace_all(title_case(F.replace(c, F.lit("_"), F.lit(" "))), PUBLICATION_NAMES)


def method_label(c: Column, plural: bool = False) -> Column:
    """Display label of an agglomeration method; an unknown one raises."""
    out = F.raise_error(F.concat(F.lit("unsupported agglomeration method: "), c)).cast("string")
    for key, names in METHOD_LABELS.items():
        out = F.when(c == key, F.lit(names[int(plural)])).otherwise(out)
    return out


def short_id(name: Column) -> Column:
    """Identifier made of first three letters, length and last letter."""
    return F.concat_ws("-", F.substring(name, 1, 3), F.length(name).cast("string"), F.right(name, F.lit(1)))


def pair_id(a: Column, b: Column) -> Column:
    return F.concat_ws("-", F.upper(a), F.upper(b))


def province_id(province: Column, country: Column) -> Column:
    """Upper-case dashed province, or country where the province is missing."""
    return F.replace(F.upper(F.coalesce(province, country)), F.lit(" "), F.lit("-"))


def decimal_comma(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit(","), F.lit(".")).cast("double")


def strip_words(c: Column, words: list[str]) -> Column:
    """Remove each word and its upper-case form, then trim."""
    for w in words:
        c = F.replace(c, F.lit(w), F.lit(""))
        if w.upper() != w:
            c = F.replace(c, F.lit(w.upper()), F.lit(""))
    return F.trim(c)
