"""Strict JSON reading on top of VARIANT.

Spark's variant casts are lenient (text "true" reads as a boolean, 1 as "1").
Span logs need the opposite: a field counts only when its JSON type is the
expected one, so each getter checks the type before it reads the value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U32_MODULUS = 4294967296
I64_MAX = "9223372036854775807"
U64_MAX = "18446744073709551615"
U64 = "decimal(20,0)"
# Fixed value: levels of nesting that a message may have.
MAX_DEPTH = 127
# Brackets that a record may open without any value standing deep.
FLAT_DEPTH = 3
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"

_HIGH, _LOW = r"\\u[dD][89abAB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
# Past all runs of up to 308 digits without an exponent of three digits, another digit.
SUSPECT_NUMBER = r"^(?:[^0-9]*[0-9]{1,308}+(?![0-9]|[eE]\+?0*+[1-9][0-9]{2}))*+[^0-9]*+[0-9]"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# Brackets that hold brackets, of up to this many levels.
_FOLDED = 8
_BALANCED = r"[\[{](?:" * (_FOLDED - 1) + r"[\[{][\]}]" + r")*+[\]}]" * (_FOLDED - 1)
# After an even number of backslashes: a high half without a low one, or the reverse.
LONE_SURROGATE = rf"(?<!\\)(?:\\\\)*(?:{_HIGH}(?!{_LOW})|(?<!{_HIGH}){_LOW})"


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options that span log jobs need.

    A repeated object key keeps its last value instead of failing the parse. The
    long CASE and JSON expressions here compile to methods beyond the 8,000
    bytes the JVM agrees to optimise; with the limit set there, Spark splits
    such stages into small methods, which run several times faster.
    """
    spark.conf.set(DUPLICATE_KEYS, "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Lambda bodies get no common-subexpression elimination, so an array that a
    lambda refers to would otherwise be built again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _opened(message: Column) -> Column:
    # Splitting at one fixed character needs no pattern.
    return F.size(F.split(message, r"\{")) + F.size(F.split(message, r"\[")) - 2


def _inexact(message: Column) -> Column:
    """Whether numbers may have to be spelled otherwise to print as they came."""
    # A search for fixed bytes costs a tenth of a pattern and leaves few texts to it.
    ends = reduce(or_, [message.contains(f".0{end}") for end in "0,]} \t\r\n"])
    fraction = message.contains(".0") & ends & message.rlike(r"[0-9]\.0+[,\]}\s]") & (_opened(message) > FLAT_DEPTH)
    return fraction | (message.contains("-0") & message.rlike(r"-0[,\]}\s]"))


def _exact_fractions(message: Column) -> Column:
    """The text with numbers such as 1.0 and -0 spelled with an exponent.

    Parsed as they are, they become decimals and integers that print as 1 and 0; with an
    exponent they stay doubles. It matters where values are printed: below the levels
    that ``otlp.any_value`` unfolds, and for -0 everywhere. Strings are left alone.
    """
    parts = F.regexp_extract_all(message, F.lit(r'"(?:\\.|[^"\\])*+"|[^"]+|"'), F.lit(0))
    spelled = F.transform(
        parts,
        lambda t: F.when(t.startswith('"'), t).otherwise(
            F.regexp_replace(t, r"(?<![0-9.eE+-])(-?[0-9]+\.0+|-0)(?![0-9.eE])", "$1E0")
        ),
    )
    return F.when(_inexact(message), F.array_join(spelled, "")).otherwise(message)


def _stamp(message: Column) -> Column:
    return F.xxhash64(message).cast("string")


def _pair(text: Column, stamp: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit(","), stamp, F.lit("]"))


def _whole(message: Column) -> Column:
    """Whether nothing follows the first document of the text.

    Read as the first of two elements, the text must leave its own hash in second place:
    trailing text, a second document, a stray bracket or empty text all leave something
    else there. The elements are only skipped over, not built.
    """
    stamp = _stamp(message)
    return F.coalesce(F.get_json_object(_pair(message, stamp), "$[1]") == stamp, F.lit(False))


def _lone_surrogate(message: Column) -> Column:
    """Whether an escape names half a character; the regex runs only on suspects."""
    suspect = message.contains("\\u") & (message.contains("\\ud") | message.contains("\\uD"))
    return suspect & message.rlike(LONE_SURROGATE)


def _beyond_limits(message: Column) -> Column:
    """Whether a number is beyond the double range, or nesting deeper than 127 levels.

    Tests on the raw text pick suspects; only these lose their strings and are looked at
    number by number and bracket by bracket. All messages pay for the tests, so these are
    one pattern that passes over a message once, and a count of the brackets of either kind.
    """
    bare = F.regexp_replace(message, _STRING, "")
    numbers = F.regexp_extract_all(bare, F.lit(r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"), F.lit(0))
    too_large = message.rlike(SUSPECT_NUMBER) & F.exists(
        numbers, lambda n: F.abs(n.try_cast("double")) == float("inf")
    )
    steps = F.transform(
        F.regexp_extract_all(bare, F.lit(r"[\[\]{}]"), F.lit(0)), lambda b: F.when(b.isin("[", "{"), 1).otherwise(-1)
    )
    deepest = F.aggregate(
        steps, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda s, x: F.struct((s["now"] + x).alias("now"), F.greatest(s["most"], s["now"] + x).alias("most")),
        lambda s: s["most"],
    )
    # Two times all that is balanced within eight levels goes; few documents leave much.
    rest = F.regexp_replace(message, _STRING + r'|[^\[\]{}"]+', "")
    for _ in range(2):
        rest = F.regexp_replace(rest, _BALANCED, "")
    many = (_opened(message) > MAX_DEPTH) & (F.length(rest) > 2 * (MAX_DEPTH - 2 * _FOLDED))
    return too_large | (many & (deepest > MAX_DEPTH))


def _sound(message: Column) -> Column:
    return ~_lone_surrogate(message) & ~_beyond_limits(message)


def _parseable(message: Column) -> Column:
    """The text as it is to be parsed; null if it must not be. Few texts need the strict look."""
    suspect = (
        message.contains("\\u") | message.rlike(SUSPECT_NUMBER) | (_opened(message) > MAX_DEPTH) | _inexact(message)
    )
    return F.when(~suspect, message).when(_sound(message), _exact_fractions(message))


def parse_message(message: Column) -> Column:
    """JSON text to VARIANT; null unless the text is exactly one JSON document.

    ``try_parse_json`` ignores whatever follows the first document, so that is tested apart;
    taking the document out of a larger one would build it a second time.
    """
    return F.when(_whole(message) & _sound(message), F.try_parse_json(_exact_fractions(message)))


def once(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Add a costly column in a way that computes it only once per row.

    Filters move down through projections and take a copy of the expressions
    they test with them. They do not move through a generator, so the finished
    column passes through an explode of one element.
    """
    computed = df.withColumn("_once", column)
    return computed.select(*df.columns, F.explode(F.array("_once")).alias(name))


def with_document(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add column ``name``, the parsed ``text``, as ``parse_message`` has it.

    The text is parsed once, as the first of two elements, of which the second must be its
    own hash (see ``_whole``). The elements come out of a generator, which cuts the document
    out of the pair as it stands and which, like ``once``, filters do not cross.
    Fails in a session without ``configure``, which would take a repeated key for bad JSON.
    """
    spark = df.sparkSession
    if spark.conf.get(DUPLICATE_KEYS, "false") != "true":
        raise RuntimeError(f"call spanflow.configure(spark) first: {DUPLICATE_KEYS} is not set")
    stamped = df.withColumn("_text", text).withColumn("_stamp", _stamp(F.col("_text")))
    pair = F.try_parse_json(_pair(_parseable(F.col("_text")), F.col("_stamp")))
    whole = F.try_variant_get("_pair", "$[1]", "string").eqNullSafe(F.col("_stamp"))
    paired = stamped.withColumn("_pair", pair).withColumn("_whole", whole).drop("_text", "_stamp")
    elements = spark.tvf.variant_explode_outer(F.col("_pair").outer()).toDF("_place", "_key", "_element")
    first = paired.lateralJoin(elements).where(F.coalesce("_place", F.lit(0)) == 0)
    return first.select(*[c for c in df.columns if c != name], F.when(F.col("_whole"), F.col("_element")).alias(name))


def field(doc: Column, path: str) -> Column:
    """Value at ``path`` as VARIANT; null when absent, a JSON null stays a value."""
    return F.try_variant_get(doc, path, "variant")


def type_name(value: Column) -> Column:
    return F.schema_of_variant(value)


def present(doc: Column, path: str) -> Column:
    return field(doc, path).isNotNull()


def strict_str(doc: Column, path: str) -> Column:
    return F.when(
        type_name(field(doc, path)) == "STRING", F.try_variant_get(doc, path, "string")
    )


def fields(doc: Column, schema: str) -> Column:
    """Fields of an object, as ``struct`` text names them, read in one pass; null for all else."""
    return F.try_variant_get(doc, "$", schema)


def only_fields(doc: Column, names: list[str]) -> Column:
    """The object with these fields alone, null where it lacks one; for ``names`` that are
    asked for their value or elements, not for their presence."""
    if not names:
        return F.when(doc.isNotNull(), F.try_parse_json(F.lit("{}")))
    return F.to_variant_object(fields(doc, f"struct<{','.join(f'{name}:variant' for name in names)}>"))


def str_of(value: Column) -> Column:
    """``strict_str`` of a value that ``fields`` read."""
    return F.when(type_name(value) == "STRING", F.try_variant_get(value, "$", "string"))


def u64_of(value: Column) -> Column:
    """``strict_u64`` of a value that ``fields`` read."""
    return _u64(type_name(value), value, "$")


def strict_true(doc: Column, path: str) -> Column:
    """True only for the JSON literal ``true``; never null."""
    return F.coalesce(
        (type_name(field(doc, path)) == "BOOLEAN")
        & F.try_variant_get(doc, path, "boolean"),
        F.lit(False),
    )


def strict_bool(doc: Column, path: str) -> Column:
    return F.when(
        type_name(field(doc, path)) == "BOOLEAN",
        F.try_variant_get(doc, path, "boolean"),
    )


def strict_u64(doc: Column, path: str) -> Column:
    """Non-negative integer up to 2**64-1 as DECIMAL(20,0).

    Integers beyond 64 signed bits arrive as decimals of scale 0. Smaller
    decimals of scale 0 were written with a fraction (``1.0``) and do not count.
    """
    return _u64(type_name(field(doc, path)), doc, path)


def _u64(kind: Column, doc: Column, path: str) -> Column:
    small = F.try_variant_get(doc, path, "bigint")
    large = F.try_variant_get(doc, path, U64)
    return F.when(kind == "BIGINT", F.when(small >= 0, small.cast(U64))).when(
        kind.isin("DECIMAL(19,0)", "DECIMAL(20,0)")
        & (large > F.lit(I64_MAX).cast(U64))
        & (large <= F.lit(U64_MAX).cast(U64)),
        large,
    )


def strict_array(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "array<variant>")


def strict_object(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "map<string,variant>")


def wrap_u32(number: Column) -> Column:
    """Keep the low 32 bits of an unsigned integer; absent counts as 0."""
    return F.coalesce(
        F.pmod(number, F.lit(U32_MODULUS).cast(U64)).cast("bigint"), F.lit(0)
    )


def json_quote(text: Column) -> Column:
    """Text as a quoted and escaped JSON string."""
    return F.to_json(text.cast("variant"))
