"""JSON text to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

BAD = "_bad"


_STEP = "_step"


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """df with an expensive column, evaluated once per row.

    Conditions on a plain column are pushed below its projection and would evaluate it a second time;
    they are not pushed below a generator. The generator only hands the value on: a projection is compiled, what stands
    in a generator is interpreted as soon as one function in it is.
    """
    made = df.select("*", column.alias(_STEP))
    return made.select("*", F.explode(F.array(_STEP)).alias(name)).drop(_STEP)


def _as_text(kind: T.DataType) -> T.DataType:
    """The same shape with text at the leaves."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return kind if isinstance(kind, T.MapType) else T.StringType()


def parse(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Parse JSON text into struct column `rec`; what is no JSON object lands in rec._bad, the rest stays null.

    Values are read as text and cast one by one: one that does not fit its type is null and takes nothing with it.
    """
    typed = T.StructType.fromDDL(schema)
    wide = T.StructType([*_as_text(typed).fields, T.StructField(BAD, T.StringType())])
    raw = with_once(df, "_raw", F.from_json(F.col(value), wide, {"columnNameOfCorruptRecord": BAD}))
    # A value of another shape marks the record as corrupt too; such records are looked at a second time.
    misfit = F.col(f"_raw.{BAD}")
    bad = F.when(misfit.isNotNull() & ~is_object(misfit), misfit)
    fields = [F.col("_raw")[f.name].try_cast(f.dataType).alias(f.name) for f in typed.fields]
    rec = F.when(F.col("_raw").isNotNull(), F.struct(*fields, bad.alias(BAD)))
    return raw.withColumn("rec", rec).drop("_raw")


def _as_map(text: Column) -> Column:
    """Member texts of a JSON object in order, texts of strings without their quotes; null if it is none."""
    return F.from_json(text, "map<string,string>")


def quoted(text: Column) -> Column:
    """A string as JSON."""
    plain = F.concat(F.lit('"'), text, F.lit('"'))
    escaped = F.to_json(F.struct(text.alias("t")))
    return F.when(text.rlike('[\\\\"\\x00-\\x1f]'), F.substr(escaped, F.lit(6), F.length(escaped) - 6)).otherwise(plain)


def _of_variant(value: Column) -> Column:
    return F.coalesce(F.to_json(value), F.lit("null"))


# Text that is JSON as it stands: a number, a literal, or what opens like an array or object. It may have been a string.
_STANDS = r'(?s)^(-?[0-9][0-9.eE+\-]*|true|false|null|[\[{].*)$'


def member_texts(df: DataFrame, value: str, known: Sequence[str], name: str) -> DataFrame:
    """df with column `name`: struct<names, texts> of a JSON object's members as JSON texts, the last one first; null if the
    value is none.

    One pass gives the members, strings without their quotes. `known` names members that are usually no strings. Where the text
    has no string after such a name, and the values of other members cannot be anything but strings, that is all.
    Else the text is parsed a second time, to a variant, which tells strings; only an object that repeats a key cannot be:
    there a value that could stand as it is counts as a string if the text has a string after its name.
    """
    split, text = with_once(df, "_map", _as_map(F.col(value))), F.col(value)
    names, values = F.map_keys("_map"), F.map_values("_map")
    ambiguous = F.exists(F.zip_with(names, values, lambda n, v: ~n.isin(*known) & F.coalesce(v.rlike(_STANDS), F.lit(False))), lambda x: x)
    unsure = text.rlike(f'"({"|".join(known)})"\\s*:\\s*"') | F.when(
        F.size(F.array_except(names, F.array(*[F.lit(n) for n in known]))) > 0, ambiguous).otherwise(False)
    split = with_once(split, "_unsure", unsure)
    unsure, typed = F.col("_unsure"), F.col("_typed")
    split = with_once(split, "_typed", F.when(unsure, F.try_parse_json(text).try_cast("map<string,variant>")))
    null = F.lit("null")
    direct = F.zip_with(names, values, lambda n, v: F.when(v.isNull(), null).when(n.isin(*known), v).otherwise(quoted(v)))
    told = F.transform(names, lambda n: _of_variant(typed[n]))
    guessed = F.zip_with(names, values, lambda n, v: F.when(v.isNull(), null).when(
        ~v.rlike(_STANDS) | F.rlike(text, F.concat(F.lit('"\\Q'), n, F.lit('\\E"\\s*:\\s*"'))), quoted(v)).otherwise(v))
    texts = F.when(~unsure, direct).when(typed.isNotNull(), told).otherwise(guessed)
    found = F.when(F.col("_map").isNotNull(), F.struct(F.reverse(names).alias("names"), F.reverse(texts).alias("texts")))
    return with_once(split, name, found).select(*df.columns, name)


def items(text: Column) -> Column:
    """The elements of a JSON array, strings without their quotes; null if the text is none."""
    return F.from_json(text, "array<string>")


def item_texts(text: Column, elements: Column) -> Column:
    """The elements of a JSON array as JSON texts; `elements` are its `items`, which stand as they are if all are objects."""
    plain = F.forall(elements, lambda v: F.coalesce(v.startswith("{"), F.lit(False))) & ~text.rlike(r'[\[,]\s*"\s*\{')
    told = F.transform(F.try_parse_json(text).try_cast("array<variant>"), _of_variant)
    return F.when(plain, elements).otherwise(F.coalesce(told, F.transform(elements, lambda v: F.coalesce(v, F.lit("null")))))


def is_object(text: Column) -> Column:
    return _as_map(text).isNotNull()


def is_bad() -> Column:
    return F.col(f"rec.{BAD}").isNotNull()


def record(columns) -> Column:
    """JSON text of one row; null fields are left out, as in the input records."""
    return F.to_json(F.struct(*columns))


def get_text(value, path: str) -> Column:
    return F.get_json_object(value, path)
