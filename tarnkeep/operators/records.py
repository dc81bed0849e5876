"""Records out of API response bodies, and tables out of records."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def json_path(parts: Sequence[str]) -> str:
    """The path expression of nested keys, each key quoted."""
    return "$" + "".join(
        f'["{p}"]' if "'" in p else f"['{p}']" for p in parts
    )


def _body_items(body: Column, items_path: str | None) -> Column:
    """The records of a body as an array of variants.

    An array is its own record list. In an object the value at the dotted path is used, a list
    giving its items and anything else one record; with no value there, the first list among the
    object's values in document order. Anything else gives no record.
    """
    parsed = F.try_parse_json(body)
    whole = F.try_variant_get(parsed, "$", "array<variant>")
    parts = [p for p in (items_path or "").split(".") if p]

    # a string-keyed map keeps the document order of keys, and is null unless the body is an object
    entries = F.from_json(body, "map<string,variant>")
    lists = F.filter(
        F.map_values(entries),
        lambda v: F.try_variant_get(v, "$", "array<variant>").isNotNull(),
    )
    first_list = F.try_variant_get(F.get(lists, F.lit(0)), "$", "array<variant>")

    if not parts:
        return F.coalesce(whole, F.when(entries.isNotNull(), F.array(parsed)))
    path = json_path(parts)
    found = F.try_variant_get(parsed, path, "variant")
    return F.coalesce(
        whole,
        F.try_variant_get(parsed, path, "array<variant>"),
        F.when(~F.is_variant_null(found) & found.isNotNull(), F.array(found)),
        first_list,
    )


def _broken(body: Column) -> Column:
    """A body that is there but can't be read: no JSON, a repeated key, or beyond a variant's size."""
    return body.isNotNull() & F.try_parse_json(body).isNull()


def extract_items(
    df: DataFrame,
    body: str = "body",
    items_path: str | None = "items",
    out: str = "item",
    on_broken: str = "raise",
) -> DataFrame:
    """One row per record of each response body; the other columns are repeated.

    A body that can't be read fails the query. With ``on_broken="skip"`` it gives no record;
    :func:`body_rejects` has these bodies. A null body has no records.
    """
    kept = [c for c in df.columns if c != body]
    text = F.col(body)
    items = _body_items(text, items_path)
    if on_broken == "raise":
        failure = F.raise_error(F.concat(F.lit("body can't be read: "), F.left(text, F.lit(100))))
        items = F.when(_broken(text), failure.cast("array<variant>")).otherwise(items)
    elif on_broken != "skip":
        raise ValueError(f"on_broken is raise or skip, not {on_broken}")
    return df.select(*kept, F.explode(items).alias(out))


def body_rejects(df: DataFrame, body: str = "body") -> DataFrame:
    """The rows whose body can't be read, as they are."""
    return df.filter(_broken(F.col(body)))


# Kinds of JSON values and the column types of those that need no closer look.
_SCALARS = {
    "string": T.StringType(),
    "whole": T.LongType(),
    "large": T.DecimalType(38, 0),
    "fraction": T.DoubleType(),
    "boolean": T.BooleanType(),
}
#: Whole numbers that need more digits than a BIGINT has; the least digits that some of them have.
_LARGE = 19


#: Kinds by the name of a variant's type; DECIMAL has its digits behind it.
_KINDS = {
    "STRING": "string", "BIGINT": "whole", "BOOLEAN": "boolean", "VOID": "null", "OBJECT": "object",
    "ARRAY": "array",
}


def _type_name(value: Column) -> Column:
    """A value's type without what is below it: few different texts, whatever the data."""
    return F.substring_index(F.schema_of_variant(value), "<", 1)


def _kinds(names: Sequence[str]) -> set[str]:
    def kind(name: str) -> str:
        digits = re.fullmatch(r"DECIMAL\((\d+),0\)", name)
        if digits and int(digits[1]) >= _LARGE:
            return "large"
        return _KINDS.get(name, "fraction")

    return {kind(name) for name in names}


#: Steps of a path below a record: an array's elements, the values of an object whose keys are
#: data, and (with the key after it) an object's field.
_ELEMENT, _VALUE, _FIELD = "[]", "{}", "."

Path = tuple[str, ...]


def _path_column(path: Path) -> Column:
    return F.array(*[F.lit(step) for step in path]).cast("array<string>")


def path_kinds(df: DataFrame, item: str, most_keys: int) -> dict[Path, set[str]]:
    """The kinds of values at every path below the records that are objects.

    One pass for each level of nesting, over what is nested that deep. The driver gets one row per
    path and at most ``most_keys`` + 1 keys of an object; where there are more, keys are data, and
    their values share one path.
    """
    below_value = df.sparkSession.tvf.variant_explode(F.col("whole").outer())
    step = F.when(F.col("key").isNull(), F.lit(_ELEMENT)).otherwise(F.concat(F.lit(_FIELD), "key"))
    level = df.select(_path_column(()).alias("path"), F.col(item).alias("whole"))
    found: dict[Path, set[str]] = {}
    while True:
        below = level.lateralJoin(below_value).select(
            "path", step.alias("step"), "value", _type_name(F.col("value")).alias("name")
        )
        if not found:
            below = below.filter(F.col("step") != _ELEMENT)  # records that are lists are no objects
        first = F.row_number().over(Window.partitionBy("path").orderBy("step"))
        rows = (
            below.groupBy("path", "step").agg(F.collect_set("name").alias("names"))
            .withColumn("place", first).filter(F.col("place") <= most_keys + 1).collect()
        )
        steps: dict[Path, dict[str, set[str]]] = defaultdict(dict)
        for r in rows:
            steps[tuple(r.path)][r.step] = _kinds(r.names)
        wide = [path for path, kinds in steps.items() if len(kinds) > most_keys]
        shared = F.lit(False)
        for path in wide:
            shared |= F.col("path") == _path_column(path)
        if wide:
            for r in below.filter(shared).groupBy("path").agg(F.collect_set("name").alias("names")).collect():
                steps[tuple(r.path)] = {_VALUE: _kinds(r.names)}
        new = {(*path, s): kinds for path, after in steps.items() for s, kinds in after.items()}
        found |= new
        if not any(kinds & {"object", "array"} for kinds in new.values()):
            return found
        last = F.when(shared, F.lit(_VALUE)).otherwise(F.col("step"))
        level = below.filter(F.col("name").isin("OBJECT", "ARRAY")).select(
            F.concat("path", F.array(last)).alias("path"), F.col("value").alias("whole")
        )


class _Types:
    """Types of paths, from the kinds at and below them; None where values cannot share one."""

    def __init__(self, kinds: dict[Path, set[str]]) -> None:
        self.kinds = kinds
        self.steps: dict[Path, list[str]] = defaultdict(list)
        for path in sorted(kinds):
            self.steps[path[:-1]].append(path[-1])

    def of(self, path: Path, column: bool = False) -> T.DataType | None:
        """The type at a path; in a ``column`` text takes in other scalars, and numbers do not mix."""
        kinds = self.kinds.get(path, set()) - {"null"}
        if not kinds:
            return T.StringType()
        if kinds <= set(_SCALARS):
            return self._scalar(kinds, column)
        if len(kinds) > 1:
            return None
        if kinds == {"array"}:
            element = self.of((*path, _ELEMENT))
            return element and T.ArrayType(element)
        return self._object(path)

    @staticmethod
    def _scalar(kinds: set[str], column: bool) -> T.DataType | None:
        if column and "string" in kinds:
            return T.StringType()
        if kinds == {"whole", "large"}:
            return _SCALARS["large"]
        if len(kinds) == 1:
            return _SCALARS[next(iter(kinds))]
        if not column and kinds <= {"whole", "large", "fraction"}:
            return T.DoubleType()
        return None

    def _object(self, path: Path) -> T.DataType | None:
        """Objects whose keys are data, or whose fields share a type, become maps, others structs."""
        fields = [(s, self.of((*path, s))) for s in self.steps[path]]
        if any(kind is None for _, kind in fields):
            return None
        kinds = {kind.simpleString(): kind for _, kind in fields}
        if len(kinds) < 2:
            return T.MapType(T.StringType(), next(iter(kinds.values()), T.StringType()))
        return T.StructType([T.StructField(s.removeprefix(_FIELD), k) for s, k in fields])


def infer_item_schema(
    df: DataFrame, item: str = "item", most_keys: int = 10_000
) -> T.StructType | T.MapType:
    """The columns of the records, sorted by name.

    Types are found for each path, at any depth. Objects whose fields share a type become maps, and so do
    those with more than ``most_keys`` different keys over all records: such keys are data (ids, say).
    Where the records themselves are such objects the result is the type of that map; its values
    are text if they cannot share a type.

    Whole and fractional numbers do not merge in a column (below it they make doubles), nor do scalars
    and nested values. Whole numbers beyond BIGINT, up to 38 digits, make a DECIMAL column. If one
    column's values cannot share a type, every column is text.
    """
    found = _Types(path_kinds(df, item, most_keys))
    columns = found.steps[()]
    if columns == [_VALUE]:
        return T.MapType(T.StringType(), found.of((_VALUE,)) or T.StringType())
    types = {c.removeprefix(_FIELD): found.of((c,), column=True) for c in columns}
    if any(t is None for t in types.values()):
        types = dict.fromkeys(types, T.StringType())
    return T.StructType([T.StructField(k, types[k]) for k in sorted(types)])


def _type_text(data_type: T.DataType) -> str:
    """The type in SQL, with nested names quoted where they need it."""
    return T.StructType([T.StructField("c", data_type)]).toDDL().removeprefix("c ")


def items_to_table(
    df: DataFrame, schema: T.StructType | str | None = None, item: str = "item",
    most_keys: int = 10_000,
) -> DataFrame:
    """Records as a table; the schema is inferred unless given.

    Inference goes through the records once before for each level of nesting; save them first where
    they are dear to make. A value that does not fit its column's type is null. Records that are no
    objects give one text column ``value``, and records whose keys are data (more than ``most_keys``)
    one map column ``value``.
    """
    if schema is None:
        schema = infer_item_schema(df, item, most_keys)
        if isinstance(schema, T.MapType):
            whole = F.try_variant_get(F.col(item), "$", _type_text(schema))
            return df.select(whole.alias("value"))
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not schema.fields:
        return df.select(F.try_variant_get(F.col(item), "$", "string").alias("value"))
    return df.select(*[
        F.try_variant_get(F.col(item), json_path([f.name]), _type_text(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
