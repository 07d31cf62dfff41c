"""Answers of models held to the JSON schema they were asked for."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import bind

# What the name of a value's type starts with, by the schema's name of it.
_TYPES = {"string": "STRING", "boolean": "BOOLEAN"}


def contract_fault(content: Column, contract: Mapping) -> Column:
    """The first fault of a JSON text by path, such as `$.links[2].url: missing`; null if it keeps
    the contract.

    `contract` is a JSON schema of closed objects, lists, texts, whole numbers, booleans and
    enums, with references into its own `$defs`. Keys are looked at in the schema's order:
    missing ones first, then unknown ones (the first by name), then what is inside. A text that
    is no JSON, one with a key twice among them, and a null text have the fault `$: no JSON`.
    The schema becomes one column expression on a VARIANT; each level of it is evaluated once.
    """
    defs = contract.get("$defs", {})
    return bind(
        F.try_parse_json(content),
        lambda value: F.when(value.isNull(), "$: no JSON").otherwise(_fault(value, contract, F.lit("$"), defs)),
    )


def _fault(value: Column, schema: Mapping, path: Column, defs: Mapping) -> Column:
    if "$ref" in schema:
        return _fault(value, defs[schema["$ref"].rsplit("/", 1)[1]], path, defs)
    if schema["type"] == "object":
        return _object_fault(value, schema["properties"], path, defs)
    if schema["type"] == "array":
        return _array_fault(value, schema["items"], path, defs)
    kind = schema["type"]
    found, written = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    if kind == "integer":
        # 2.0 is a whole number; 2.5, 1e3 and "2" are not.
        right = (found.startswith("BIGINT") | found.startswith("DECIMAL")) & written.rlike(r"^-?[0-9]+(\.0+)?$")
        written = F.regexp_replace(written, r"\.0+$", "")
    else:
        right = found == _TYPES[kind]
    fault = F.when(~F.coalesce(right, F.lit(False)), F.concat(path, F.lit(f": no {kind}")))
    if "enum" not in schema:
        return fault
    known = written.isin(*[str(x) for x in schema["enum"]])
    return F.coalesce(fault, F.when(~known, F.concat(path, F.lit(": unknown value"))))


def _object_fault(value: Column, properties: Mapping, path: Column, defs: Mapping) -> Column:
    names = F.array(*[F.lit(name) for name in properties])

    def check(held: Column) -> Column:
        missing = F.array_except(names, F.map_keys(held))
        unknown = F.array_sort(F.array_except(F.map_keys(held), names))

        def at(name: Column) -> Column:
            return F.concat(path, F.lit("."), name)

        inside = [
            bind(
                F.try_element_at(held, F.lit(name)),
                lambda v, name=name, inner=inner: _fault(v, inner, at(F.lit(name)), defs),
            )
            for name, inner in properties.items()
        ]
        return (
            F.when(held.isNull(), F.concat(path, F.lit(": no object")))
            .when(F.size(missing) > 0, F.concat(at(F.get(missing, F.lit(0))), F.lit(": missing")))
            .when(F.size(unknown) > 0, F.concat(at(F.get(unknown, F.lit(0))), F.lit(": unknown key")))
            .otherwise(F.coalesce(*inside, F.lit(None).cast("string")))
        )

    return bind(F.try_variant_get(value, "$", "map<string, variant>"), check)


def _array_fault(value: Column, items: Mapping, path: Column, defs: Mapping) -> Column:
    def check(entries: Column) -> Column:
        faults = F.transform(
            entries, lambda v, i: _fault(v, items, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), defs)
        )
        first = F.get(F.filter(faults, lambda f: f.isNotNull()), F.lit(0))
        return F.when(entries.isNull(), F.concat(path, F.lit(": no array"))).otherwise(first)

    return bind(F.try_variant_get(value, "$", "array<variant>"), check)
