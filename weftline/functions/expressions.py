"""Null-safe predicates, names, quantities and vectors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_stated(column: str | Column = "stated") -> Column:
    """True or false for a flag that is true or absent."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(False))


def declared(source: str = "source_file") -> Column:
    return F.col(source).isNotNull()


def location(file: str = "source_file", line: str = "source_line") -> Column:
    """``file:line``; absent parts count as empty text."""
    return F.concat(F.coalesce(F.col(file), F.lit("")), F.lit(":"), F.coalesce(F.col(line).cast("string"), F.lit("")))


def total(column: Column) -> Column:
    """A sum that is 0 over nothing."""
    return F.coalesce(F.sum(column), F.lit(0))


def exact_total(column: Column) -> Column:
    """A sum of money or quantities that does not depend on the order of rows."""
    return F.coalesce(F.sum(column.cast("decimal(18,2)")), F.lit(0)).cast("double")


def attribute(name: str, field: str = "value", attributes: str = "attributes") -> Column:
    """A path through the attribute map; null wherever a part is missing."""
    return F.element_at(F.col(attributes), F.lit(name)).getField(field)


def has_attributes(attributes: str = "attributes") -> Column:
    return F.size(F.coalesce(F.map_keys(F.col(attributes)), F.array())) > 0


def last_segment(name: Column) -> Column:
    return F.element_at(F.split(name, "::"), -1)


def alias_key(name: Column) -> Column:
    """The comparable form of a written name: last segment, upper case, letters and digits."""
    return F.regexp_replace(F.upper(last_segment(name)), "[^A-Z0-9]", "")


def ends_as(name: Column, wanted: Column, strict: bool = True) -> Column:
    """Whether a name is ``wanted`` or ends in an underscore and ``wanted``.

    Not strict: any one character stands for the underscore, as in a LIKE pattern.
    """
    if strict:
        return (name == wanted) | name.endswith(F.concat(F.lit("_"), wanted))
    return (name == wanted) | (name.endswith(wanted) & (F.length(name) > F.length(wanted)))


def model_of(path: Column) -> Column:
    """The top entry a source file lies under."""
    return F.regexp_replace(F.split(path, "/").getItem(0), r"\.sysml$", "")


def entity_key(name: Column, number: Column) -> Column:
    return F.concat(F.xxhash64(name).cast("string"), F.lit("_"), number.cast("string"))


def slug_key(text: Column) -> Column:
    """A readable key: the slug, and a digest that keeps cut or equal slugs apart.

    Fixed values: the characters kept, 180 of them, and the first ten digits of SHA-1.
    """
    slug = F.substring(F.regexp_replace(text, "[^A-Za-z0-9_-]+", "_"), 1, 180)
    return F.concat(F.regexp_replace(slug, "^_+|_+$", ""), F.lit("_"), F.substring(F.sha1(text), 1, 10))


#: Fixed value: how the notation writes a number.
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"


def _bare(token: Column) -> Column:
    """A token without the quotation marks around it, if it has any."""
    mark = F.left(token, F.lit(1))
    return F.when((F.length(token) > 1) & mark.isin("'", '"') & (F.right(token, F.lit(1)) == mark), F.substr(token, F.lit(2), F.length(token) - 2)).otherwise(token)


def quantity(raw: Column) -> Column:
    """``struct<value, text, unit, expression>`` of a written value; null if nothing is written."""
    written = F.trim(F.rtrim(F.trim(raw), F.lit("; ")))
    at = F.locate("[", written)
    number = F.when(at > 0, F.rtrim(F.left(written, at - 1))).otherwise(written)
    behind = F.when(at > 0, F.substr(written, at + 1))
    inside = F.substring_index(behind, "]", 1)
    whole = (at == 0) | (F.length(inside) > 0) & (behind == F.concat(inside, F.lit("]")))
    is_number = whole & number.rlike(f"^{NUMBER}$")
    is_text = ~is_number & F.left(written, F.lit(1)).isin("'", '"')
    unit = F.nullif(_bare(F.trim(F.element_at(F.split(inside, "::"), -1))), F.lit(""))
    says = {"value": F.when(is_number, number.try_cast("double")), "text": F.when(is_text, _bare(written)), "unit": F.when(is_number, unit), "expression": F.when(~is_number & ~is_text, written)}
    return F.when(F.length(written) > 0, F.struct(*[c.alias(k) for k, c in says.items()]))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if a vector is missing or zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def words(text: Column) -> Column:
    """Lower-case ASCII words."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
