"""JSON values to messages and back.

Numbers and booleans in a string field become text, numbers as they were sent, extra
fields are ignored and missing ones are null. What the message schema cannot hold
is named in a ``reason`` column and then either stops the job or is set aside.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.schema import MESSAGE_FIELDS, PROFANITY, SAFE

# Why a value is not a message.
MALFORMED = "malformed_json"
NULL_RECORD = "null_record"
NOT_OBJECT = "not_an_object"
NESTED_FIELD = "nested_field"
TOO_LARGE = "too_large"
UNKNOWN_TYPE = "unknown_profanity_type"

# The parsed form of a value has at most 128 MiB; a larger value gets its own reason.
MAX_VALUE_BYTES = 128 * 1024 * 1024

FAILFAST = "failfast"
QUARANTINE = "quarantine"


def _field(name: str, kind: str) -> Column:
    return F.variant_get("_json", f"$.{name}", kind)


def _kind(name: str) -> Column:
    return F.schema_of_variant(_field(name, "variant"))


def _nested(name: str) -> Column:
    return F.coalesce(F.substring(_kind(name), 1, 5).isin("OBJEC", "ARRAY"), F.lit(False))


def _number(name: str) -> tuple[Column, Column]:
    """The text a number field was sent as, and whether it is certain.

    Inside a JSON string every quote has a backslash, so the quoted name and a number
    after it can only be a member; it is this one if it is the only one of equal value.
    """
    sent = F.regexp_extract_all("value", F.lit(rf'"{name}"\s*:\s*(-?[0-9][-+.eE0-9]*)'), F.lit(1))
    only = F.try_element_at(sent, F.lit(1))
    same = only.try_cast("double").eqNullSafe(_field(name, "double"))
    return only, (F.size(sent) == 1) & same


def _is_number(name: str) -> Column:
    return ~F.coalesce(_kind(name).isin("STRING", "BOOLEAN", "VOID"), F.lit(True))


def _uncertain(name: str) -> Column:
    return _is_number(name) & ~_number(name)[1]


def top_numbers(value: str) -> Column:
    """(key, text) of the numbers that are members of the outermost object, keys still quoted: one pass over the words of a value.

    Two-character escapes are blanked first, so that what is left between quotes is a string. A word after a colon at
    depth one is a member's value, what was before the colon its key.
    """
    flat = F.regexp_replace(value, r'\\["\\/bfnrt]', "~~")
    words = F.regexp_extract_all(flat, F.lit(r'"[^"]*+"|[{}\[\]:,]|[^\s{}\[\]:,"]++'), F.lit(0))
    nothing = F.expr("cast(array() as array<struct<key: string, text: string>>)")
    begin = F.struct(F.lit(0).alias("depth"), F.lit("").alias("before"), F.lit("").alias("key"), nothing.alias("found"))

    def step(at: Column, word: Column) -> Column:
        opened = F.when(word.isin("{", "["), 1).when(word.isin("}", "]"), -1).otherwise(0)
        member = (at["depth"] == 1) & (at["before"] == ":") & word.rlike("^-?[0-9]")
        found = F.struct(at["key"].alias("key"), word.alias("text"))
        return F.struct(
            (at["depth"] + opened).alias("depth"),
            word.alias("before"),
            F.when(word == ":", at["before"]).otherwise(at["key"]).alias("key"),
            F.when(member, F.array_append(at["found"], found)).otherwise(at["found"]).alias("found"),
        )

    return F.aggregate(words, begin, step, lambda at: at["found"])


def _sent(name: str) -> Column:
    """The text of the last top-level number of this name; a name may be written with escapes."""
    unescaped = lambda key: F.when(key.contains("\\"), F.get_json_object(F.concat(F.lit('{"k":'), key, F.lit("}")), "$.k"))
    named = F.filter("_sent", lambda m: F.coalesce(unescaped(m["key"]), F.btrim(m["key"], F.lit('"'))) == name)
    return F.try_element_at(named, F.lit(-1))["text"]


def _text(name: str) -> Column:
    text, certain = _number(name)
    plain = _field(name, "string")
    return F.when(_is_number(name) & certain, text).when(_is_number(name), F.coalesce(_sent(name), plain)).otherwise(plain)


def _any(check, names=MESSAGE_FIELDS) -> Column:
    return reduce(Column.__or__, map(check, names))


def inspect_json(raw: DataFrame) -> DataFrame:
    """The message fields of ``value``, and the ``reason`` it is unusable, if any.

    ``value`` itself is kept only beside a reason. The parsed value comes out of
    a one-element explode because filters move below a projection but not below
    that: the checks and fields then read it instead of parsing the text again each. Only a value in which the
    text of a number is in doubt is taken apart word by word.
    """
    reason = (
        F.when(F.col("_json").isNull() & (F.octet_length("value") > MAX_VALUE_BYTES), TOO_LARGE)
        .when(F.col("_json").isNull(), MALFORMED)
        .when(F.is_variant_null("_json"), NULL_RECORD)
        .when(~F.schema_of_variant("_json").startswith("OBJECT"), NOT_OBJECT)
        .when(_any(_nested), NESTED_FIELD)
        .when(~_field("profanity_type", "string").isin(PROFANITY, SAFE), UNKNOWN_TYPE)
    )
    others = [c for c in raw.columns if c != "value"]
    fields = [F.when(F.col("reason").isNull(), _text(name)).alias(name) for name in MESSAGE_FIELDS]
    return (
        raw.select("*", F.explode(F.array(F.try_parse_json("value"))).alias("_json"))
        .select(*others, "value", "_json", reason.alias("reason"), F.when(_any(_uncertain), top_numbers("value")).alias("_sent"))
        .select(*others, *fields, "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"))
    )


def messages_of(inspected: DataFrame) -> DataFrame:
    return inspected.where(F.col("reason").isNull()).drop("reason", "value")


def rejects_of(inspected: DataFrame) -> DataFrame:
    return inspected.where(F.col("reason").isNotNull()).drop(*MESSAGE_FIELDS)


def decode_json(raw: DataFrame) -> DataFrame:
    """Messages of ``raw``; the first unusable value stops the query.

    A JSON ``null`` is no record and is skipped.
    """
    usable = F.when(F.col("reason").isNull(), True).when(F.col("reason") == NULL_RECORD, False)
    inspected = inspect_json(raw).where(
        usable.otherwise(
            F.raise_error(F.concat(F.lit("cannot decode message: "), "reason")).cast("boolean")
        )
    )
    return messages_of(inspected)


def encode_json(messages: DataFrame, *others: str) -> DataFrame:
    """One JSON ``value`` per message: declared field order, nulls written out; and ``others`` as they are."""
    row = F.struct(*MESSAGE_FIELDS)
    return messages.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value"), *others)
