"""Functions of VARIANT values: JSON values that keep their type, so that false and "false" differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col, numeric_value


def kind(x: Column | str, name: Column | None = None) -> Column:
    """null, boolean, number, string, object or array; null for no value at all.

    ``name`` is the value's schema where a column holds it already. So is ``what``, its kind, in the
    functions below: many values are looked at once then, not once for each question.
    """
    name = F.schema_of_variant(col(x)) if name is None else name
    return (
        F.when(name.isNull(), None).when(name == "VOID", "null").when(name == "BOOLEAN", "boolean").when(name == "STRING", "string")
        .when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").otherwise("number")
    )


def _as(x: Column, type_name: str) -> Column:
    return F.try_variant_get(x, "$", type_name)


def truthy(x: Column | str) -> Column:
    """Null stays null; false, 0, the empty string, list and object are false, all else is true: "false" and "0", too."""
    x = col(x)
    what = kind(x)
    return (
        F.when(what == "boolean", _as(x, "boolean")).when(what == "string", _as(x, "string") != "").when(what == "number", _as(x, "double") != 0)
        .when(what.isin("object", "array"), ~F.to_json(x).isin("{}", "[]"))
    )


def text(x: Column | str, what: Column | None = None) -> Column:
    """The value as text: strings as they are, True and False for booleans, JSON for lists and objects, null for null."""
    x = col(x)
    what = kind(x) if what is None else what
    return F.when(what == "boolean", F.initcap(_as(x, "string"))).when(what.isin("object", "array"), F.to_json(x)).when(what != "null", _as(x, "string"))


def filled(x: Column | str) -> Column:
    """The value as text, null where it isn't ``truthy``."""
    return F.when(truthy(x), text(x))


def number(x: Column | str, what: Column | None = None) -> Column:
    """The finite number that a value is or, as a string, holds; booleans count as 1 and 0."""
    x = col(x)
    what = kind(x) if what is None else what
    plain = F.when(what == "boolean", _as(x, "boolean").cast("double")).when(what == "number", _as(x, "double"))
    return F.when(what == "string", numeric_value(_as(x, "string"))).when(F.abs(plain) < float("inf"), plain)


def other_text(x: Column | str) -> Column:
    """The value as text if it is no finite ``number``."""
    return F.when(number(x).isNull(), text(x))


def whole(x: Column | str, type_name: str = "int", what: Column | None = None) -> Column:
    """A number cut to a whole one, or an integer from a string of digits only; else null."""
    x = col(x)
    what, string = kind(x) if what is None else what, _as(x, "string")
    return F.when(what == "string", F.when(string.rlike("^[0-9]+$"), string.try_cast(type_name))).when(what.isin("number", "boolean"), number(x, what).try_cast(type_name))
