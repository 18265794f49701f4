"""Record contracts as column expressions: one array of violation texts per row.

A contract is compiled once on the driver; the per-row work is built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPARK_KINDS = {
    "string": (T.StringType,),
    "number": (T.NumericType,),
    "boolean": (T.BooleanType,),
    "object": (T.StructType,),
    "date-time": (T.TimestampType, T.TimestampNTZType),
}
_JSON_KINDS = {
    "string": "^STRING",
    "number": "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)",
    "boolean": "^BOOLEAN",
    "object": "^OBJECT",
}


def _flag(broken: Column, text: str) -> Column:
    """The text where `broken` is true, NULL where it is false or unknown."""
    return F.when(broken, F.lit(text))


def _value_rules(name: str, value: Column, rule: Mapping) -> list[Column]:
    out = []
    if "pattern" in rule:
        out.append(_flag(~value.rlike(rule["pattern"]), f"{name}: pattern"))
    if "enum" in rule:
        out.append(_flag(~value.isin(list(rule["enum"])), f"{name}: value"))
    if "minimum" in rule:
        out.append(_flag(value < rule["minimum"], f"{name}: below minimum"))
    if "maximum" in rule:
        out.append(_flag(value > rule["maximum"], f"{name}: above maximum"))
    return out


def _listed(flags: Sequence[Column]) -> Column:
    return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")


def _column_flags(schema: T.StructType, contract: Mapping, at, prefix: str, allowed_extra) -> list[Column]:
    flags = []
    present = {f.name: f.dataType for f in schema.fields}
    for name, rule in contract.items():
        label = prefix + name
        if name not in present:
            flags.append(F.lit(f"{label}: missing"))
            continue
        value, kind = at(name), present[name]
        flags.append(_flag(value.isNull(), f"{label}: missing"))
        wanted = _SPARK_KINDS[rule["type"]]
        if rule.get("format") == "date-time":
            wanted += _SPARK_KINDS["date-time"]
        if not isinstance(kind, wanted):
            flags.append(_flag(value.isNotNull(), f"{label}: type"))
        elif rule["type"] == "object":
            inner = value
            flags += _column_flags(kind, rule["fields"], inner.getField, f"{label}.", ())
        elif rule.get("format") == "date-time" and isinstance(kind, T.StringType):
            flags.append(_flag(value.isNotNull() & F.try_to_timestamp(value).isNull(), f"{label}: format"))
        else:
            flags += _value_rules(label, value, rule)
    for name in present:
        if name not in contract and name not in allowed_extra:
            flags.append(F.lit(f"{prefix}{name}: unexpected"))
    return flags


def violations(df: DataFrame, contract: Mapping, allowed_extra: Sequence[str] = ()) -> Column:
    """Violations of a typed row. A NULL counts as missing."""
    return _listed(_column_flags(df.schema, contract, lambda c: F.col(f"`{c}`"), "", set(allowed_extra)))


def contract_failures(df: DataFrame, contract: Mapping, key: str, allowed_extra: Sequence[str] = ()) -> DataFrame:
    """`key, violations` for each row that breaks the contract."""
    marked = df.select(key, violations(df, contract, allowed_extra).alias("violations"))
    return marked.where(F.size("violations") > 0)


def _key_columns(text: Column, contract: Mapping, path: str = "$") -> dict[str, Column]:
    """The names that the text has at every object of the contract, by path."""
    out = {path: F.json_object_keys(text if path == "$" else F.get_json_object(text, path))}
    for name, rule in contract.items():
        if rule["type"] == "object":
            out |= _key_columns(text, rule["fields"], f"{path}.{name}")
    return out


def _json_flags(keys_at: Mapping[str, Column], variant: Column, path: str, contract: Mapping, prefix: str, allowed_extra) -> list[Column]:
    keys = keys_at[path]
    flags = []
    for name, rule in contract.items():
        label, at = prefix + name, f"{path}.{name}"
        flags.append(_flag(~F.array_contains(keys, name), f"{label}: missing"))
        kind = F.schema_of_variant(F.try_variant_get(variant, at, "variant"))
        right_kind = kind.rlike(_JSON_KINDS[rule["type"]])
        flags.append(_flag(F.array_contains(keys, name) & ~F.coalesce(right_kind, F.lit(False)), f"{label}: type"))
        if rule["type"] == "object":
            checks = _json_flags(keys_at, variant, at, rule["fields"], f"{label}.", ())
            flags += [F.when(right_kind, c) for c in checks]
            continue
        spark_type = {"number": "double", "string": "string", "boolean": "boolean"}[rule["type"]]
        value = F.when(right_kind, F.try_variant_get(variant, at, spark_type))
        if rule.get("format") == "date-time":
            flags.append(_flag(value.isNotNull() & F.try_to_timestamp(value).isNull(), f"{label}: format"))
        flags += _value_rules(label, value, rule)
    known = F.array(*[F.lit(n) for n in (*contract, *allowed_extra)])
    unexpected = F.array_except(keys, known)
    names = F.concat(F.lit(prefix), F.array_join(F.array_sort(unexpected), ","), F.lit(": unexpected"))
    flags.append(F.when(F.size(unexpected) > 0, names))
    return flags


def _json_listed(variant: Column, keys_at: Mapping[str, Column], contract: Mapping, allowed_extra) -> Column:
    is_object = F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))
    flags = _json_flags(keys_at, variant, "$", contract, "", set(allowed_extra))
    return F.when(is_object, _listed(flags)).otherwise(F.array(F.lit("malformed")))


def json_violations(text: Column | str, contract: Mapping, allowed_extra: Sequence[str] = ()) -> Column:
    """Violations of a JSON text, checked against the types in the text itself. As an expression it reads the text
    once for every rule; `json_failures` reads it once for all."""
    text = F.col(text) if isinstance(text, str) else text
    return _json_listed(F.try_parse_json(text), _key_columns(text, contract), contract, allowed_extra)


def json_failures(df: DataFrame, contract: Mapping, key: str, column: str = "value", allowed_extra: Sequence[str] = ()) -> DataFrame:
    """`key, violations` for each row whose JSON text breaks the contract.

    The text is read in generators, whose results the rules share: as plain columns the readers would be copied into
    every rule.
    """
    once = df.select(F.col(key).alias(key), F.inline(F.array(F.struct(F.col(column).alias("_text")))))
    keys_at = _key_columns(F.col("_text"), contract)
    cells = [F.try_parse_json("_text").alias("_variant"), *[c.alias(f"_keys{k}") for k, c in enumerate(keys_at.values())]]
    parsed = once.select(key, F.inline(F.array(F.struct(*cells))))
    columns = {path: F.col(f"_keys{k}") for k, path in enumerate(keys_at)}
    listed = _json_listed(F.col("_variant"), columns, contract, allowed_extra)
    marked = parsed.select(key, F.inline(F.array(F.struct(listed.alias("violations")))))
    return marked.where(F.size("violations") > 0)
