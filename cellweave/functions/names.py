"""Text of names: accents, ordered prefix rules, codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import col

# The classes, in order, and the prefix rules, first match wins.
MODEL_CLASSES = (
    "Papa", "Cana_Panelera", "Cafe", "Maiz", "Platano", "Mango",
    "Frijol", "Cacao", "Arveja", "Palma", "Banano", "Citricos",
    "Mora", "Zanahoria", "Tomate_Arbol", "Yuca", "Habichuela",
    "Hortalizas", "Otros_cultivos", "No_apto",
)
OTHER, UNFIT = "Otros_cultivos", "No_apto"
PREFIX_RULES = (
    ("papa", "Papa"), ("cana", "Cana_Panelera"), ("cafe", "Cafe"), ("maiz", "Maiz"), ("platano", "Platano"),
    ("mango", "Mango"), ("frijol", "Frijol"), ("cacao", "Cacao"), ("arveja", "Arveja"), ("palma", "Palma"), ("banano", "Banano"),
    ("naranja", "Citricos"), ("mandarina", "Citricos"), ("limon", "Citricos"), ("tangelo", "Citricos"), ("otros citri", "Citricos"),
    ("mora", "Mora"), ("zanahoria", "Zanahoria"),
    ("tomate de arbol", "Tomate_Arbol"), ("tomate arbol", "Tomate_Arbol"), ("tomate de a", "Tomate_Arbol"),
    ("yuca", "Yuca"), ("habichuela", "Habichuela"),
    ("cebolla", "Hortalizas"), ("lechuga", "Hortalizas"), ("tomate", "Hortalizas"), ("otras horta", "Hortalizas"),
    ("cilantro", "Hortalizas"), ("ahuyama", "Hortalizas"), ("calabac", "Hortalizas"), ("espinaca", "Hortalizas"),
    ("apio", "Hortalizas"), ("repollo", "Hortalizas"), ("pimenton", "Hortalizas"), ("pepino", "Hortalizas"),
    ("remolacha", "Hortalizas"), ("brocoli", "Hortalizas"), ("acelga", "Hortalizas"), ("ajo", "Hortalizas"),
    ("esparrago", "Hortalizas"), ("rabano", "Hortalizas"), ("haba", "Hortalizas"),
)

# Latin letters with marks and the letters they stand on.
MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def strip_accents(c: Column | str) -> Column:
    """Letters without their marks, composed or followed by combining marks."""
    return F.regexp_replace(F.translate(col(c), MARKED, PLAIN), "\\p{Mn}", "")


def by_prefix(c: Column | str, rules: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """The class of the first rule whose prefix fits the trimmed, lower-cased, unmarked name."""
    name = strip_accents(F.lower(F.trim(col(c))))
    out = None
    for prefix, kind in rules:
        fits = F.startswith(name, F.lit(prefix))
        out = F.when(fits, kind) if out is None else out.when(fits, kind)
    return out.otherwise(otherwise)


def crop_class(c: Column | str) -> Column:
    return by_prefix(c, PREFIX_RULES, OTHER)


def catalogue() -> dict[str, int]:
    return {name: i for i, name in enumerate(MODEL_CLASSES)}


def class_id(c: Column | str) -> Column:
    """Position in the catalogue, missing for names outside it."""
    pairs = [x for name, i in catalogue().items() for x in (F.lit(name), F.lit(i))]
    return F.try_element_at(F.create_map(*pairs), col(c))


def in_catalogue(c: Column | str) -> Column:
    return F.when(col(c).isin(*MODEL_CLASSES), col(c)).otherwise(OTHER)


def inverted(m: Column | str) -> Column:
    """A map with keys and values exchanged."""
    return F.map_from_entries(F.transform(F.map_entries(col(m)), lambda e: F.struct(e["value"], e["key"])))


def first_alias(m: Column | str, aliases: Sequence[str]) -> Column:
    """The value of the first of several keys that a map has, whatever their case."""
    lowered = F.map_from_entries(F.transform(F.map_entries(col(m)), lambda e: F.struct(F.lower(e["key"]), e["value"])))
    return F.coalesce(*[F.try_element_at(lowered, F.lit(a.lower())) for a in aliases])


def all_digits(c: Column | str) -> Column:
    return col(c).rlike("^[0-9]+$")
