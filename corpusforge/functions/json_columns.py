"""Chat columns that arrive as serialized JSON instead of native lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from corpusforge.functions import values as V
from corpusforge.functions.text import Text, _col, strip


def parse(c: Text) -> Column:
    """JSON text as VARIANT; NULL when malformed. Parse once, in a projection
    of its own, where both the list and the kind are wanted."""
    return F.try_parse_json(_col(c))


def list_of(parsed: Column, element_type: str = V.MESSAGES_TYPE) -> Column:
    """Typed list from a parsed value; NULL when it is no list.

    Unlike from_json this keeps a list whose elements are not all objects (they
    become NULL elements) and does not turn a lone object into a list.
    """
    return F.try_variant_get(parsed, "$", element_type)


def one_of(parsed: Column, element_type: str = V.MESSAGES_TYPE) -> Column:
    """A list of one from a lone object; NULL when it is none."""
    element = element_type.removeprefix("array<").removesuffix(">")
    lone = F.try_variant_get(parsed, "$", element)
    return F.when(lone.isNotNull(), F.array(lone))


def unknown_fields(parsed: Column, element_type: str) -> Column:
    """Names of fields that a list's objects (or a lone object) have and the
    element type lacks, comma-separated; NULL for none."""
    dtype = T.DataType.fromDDL(element_type)
    names = getattr(getattr(dtype, "elementType", None), "names", None)
    if names is None:
        return F.lit(None).cast("string")
    fields = "map<string,variant>"
    objects = F.coalesce(F.try_variant_get(parsed, "$", f"array<{fields}>"), F.array(F.try_variant_get(parsed, "$", fields)))
    keys = F.array_distinct(F.flatten(F.transform(F.filter(objects, lambda o: o.isNotNull()), F.map_keys)))
    more = F.array_sort(F.array_except(keys, F.array(*map(F.lit, names))))
    return F.nullif(F.array_join(more, ", "), F.lit(""))


def kind_of(c: Text, parsed: Column) -> Column:
    """null, list, other (valid JSON but no list) or malformed."""
    c = _col(c)
    return (F.when(c.isNull(), "null")
            .when(parsed.isNull(), "malformed")
            .when(F.left(strip(c), F.lit(1)) == "[", "list")
            .otherwise("other"))


def parse_list(c: Text, element_type: str = V.MESSAGES_TYPE) -> Column:
    return list_of(parse(c), element_type)


def json_kind(c: Text) -> Column:
    return kind_of(c, parse(c))


def as_messages(c: Text, dtype: T.DataType, element_type: str = V.MESSAGES_TYPE) -> Column:
    """A list column, whether stored natively or as JSON; anything else is []."""
    empty = F.from_json(F.lit("[]"), element_type)
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(_col(c), F.array().cast(dtype))
    if isinstance(dtype, T.StringType):
        return F.coalesce(parse_list(c, element_type), empty)
    return empty
