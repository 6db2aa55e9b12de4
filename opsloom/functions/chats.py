"""Function-call chat columns: call parsing, signatures, error flags, turn texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsloom.functions import rules
from opsloom.functions.common import SPACE, col, first_match, let, strip

# A call block is a lazy {...} that reaches the end marker or the end of the chat.
CALL_BLOCK = rf"(?sU)<functioncall>{SPACE}*(\{{.*?\}}){SPACE}*(?:<\|endoftext\|>|\z)"
QUOTED_ARGUMENTS = r"(?s)'(\{.*?\})'"
STRICT_JSON = {
    "allowSingleQuotes": "false",
    "allowUnquotedFieldNames": "false",
    "allowUnquotedControlChars": "false",
    "allowNonNumericNumbers": "true",
}


def _closes_cleanly(text: Column) -> Column:
    """No text follows the first JSON value (readers stop there and would not notice)."""
    wrapped = F.concat(F.lit('{"v":'), text, F.lit("}"))
    return F.from_json(wrapped, "map<string,string>", STRICT_JSON).isNotNull()


def _single(text: Column, kind: str) -> Column:
    """The one value of ``[text]`` read as an array of ``kind``; null if the text is not
    exactly one strictly valid JSON value of that kind."""
    def read(t: Column) -> Column:
        items = F.from_json(F.concat(F.lit("["), t, F.lit("]")), f"array<{kind}>", STRICT_JSON)
        probe = F.struct(items.alias("items"), _closes_cleanly(t).alias("clean"))
        return let(
            probe, lambda p: F.when((F.array_size(p["items"]) == 1) & p["clean"], p["items"])
        )

    return let(text, read)


def json_object(text: Column) -> Column:
    """A whole, strictly valid JSON object as map of key to raw JSON text, else null."""
    return _single(text, "map<string,string>")[0]


def is_json(text: Column) -> Column:
    """True if the whole text is one strictly valid JSON value of any kind."""
    return _single(text, "string").isNotNull()


def call_blocks(chat: Column | str) -> Column:
    """Raw text of every call block in the chat."""
    return F.regexp_extract_all(
        F.coalesce(col(chat), F.lit("")), F.lit(CALL_BLOCK), F.lit(1)
    )


def function_calls(chat: Column | str) -> Column:
    """Array of {name, arguments, malformed}, one entry per call block.

    ``arguments`` is JSON text ('{}' when absent), with a quoted object or a JSON string
    unwrapped; ``malformed`` holds a block that is not JSON and is null for good calls. ``n_arguments`` is null when the arguments are not an object.
    """

    def arguments(raw: Column) -> Column:
        # a plain string that is no JSON itself stays a string: quote it again
        return F.struct(
            F.when(is_json(raw), raw).otherwise(quote_json(raw)).alias("text"),
            F.array_size(F.array_distinct(F.map_keys(json_object(raw)))).alias("n"),
        )

    def good(fields: Column) -> Column:
        raw = F.when(
            F.map_contains_key(fields, F.lit("arguments")),
            F.coalesce(fields["arguments"], F.lit("null")),
        ).otherwise("{}")
        name = F.coalesce(fields["name"], F.lit("unknown"))
        return let(raw, lambda r: let(arguments(r), lambda a: F.struct(
            name.alias("name"), a["text"].alias("arguments"),
            a["n"].alias("n_arguments"), F.lit(None).cast("string").alias("malformed"),
        )))

    def parse(block: Column) -> Column:
        nothing = F.lit(None).cast("string")
        bad = F.struct(
            nothing.alias("name"), nothing.alias("arguments"),
            F.lit(None).cast("int").alias("n_arguments"),
            block.alias("malformed"),
        )
        fields = json_object(F.regexp_replace(block, QUOTED_ARGUMENTS, "$1"))
        return let(fields, lambda f: F.when(f.isNull(), bad).otherwise(good(f)))

    return F.transform(call_blocks(chat), parse)


def has_malformed(calls: Column) -> Column:
    return F.exists(calls, lambda call: call["malformed"].isNotNull())


def complexity_tier(calls: Column) -> Column:
    """none, malformed, simple (one call, at most two arguments), moderate or complex."""
    def tier(c: Column) -> Column:
        first = F.get(c, F.lit(0))
        return first_match(
            [(F.array_size(c) == 0, "none"),
             (F.array_size(c) > 1, "complex"),
             (first["malformed"].isNotNull(), "malformed"),
             (first["n_arguments"] <= 2, "simple")],
            F.lit("moderate"),
        )

    return let(calls, tier)


def calls_json(calls: Column) -> Column:
    """The calls as one JSON array text."""
    def one(call: Column) -> Column:
        good = F.concat(
            F.lit('{"name":'), quote_json(call["name"]),
            F.lit(',"arguments":'), call["arguments"], F.lit("}"),
        )
        bad = F.to_json(F.struct(call["malformed"].alias("__malformed__")))
        return F.when(call["malformed"].isNull(), good).otherwise(bad)

    return F.concat(F.lit("["), F.array_join(F.transform(calls, one), ","), F.lit("]"))


def quote_json(text: Column) -> Column:
    """Text as a JSON string literal."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def function_signature(system: Column | str) -> Column:
    """The function defined in a system prompt: {name, description, parameters, required}.

    The text from the first to the last brace must be one JSON object with a name; a list of
    several functions is not, and gives null.
    """
    empty = F.array().cast("array<string>")
    body = F.nullif(F.regexp_extract(col(system), r"(?s)\{.*\}", 0), F.lit(""))

    def parameters(params: Column) -> Column:
        """Property names and required names; null names where properties is no object."""
        properties = json_object(F.coalesce(params["properties"], F.lit("{}")))
        required = F.from_json(F.coalesce(params["required"], F.lit("[]")), "array<string>")
        return F.when(
            params.isNull(), F.struct(empty.alias("names"), empty.alias("required"))
        ).otherwise(F.struct(
            F.map_keys(properties).alias("names"),
            F.coalesce(required, empty).alias("required"),
        ))

    def signature(fields: Column) -> Column:
        return let(
            let(json_object(fields["parameters"]), parameters),
            lambda p: F.when(
                F.map_contains_key(fields, F.lit("name")) & p["names"].isNotNull(),
                F.struct(
                    fields["name"].alias("name"),
                    F.coalesce(fields["description"], F.lit("")).alias("description"),
                    p["names"].alias("parameters"), p["required"].alias("required"),
                ),
            ),
        )

    return let(json_object(body), signature)


def signatures_json(signature: Column) -> Column:
    """The signature as a JSON object keyed by function name, '{}' if there is none."""
    body = F.to_json(F.struct(
        signature["description"].alias("description"),
        signature["parameters"].alias("parameters"),
        signature["required"].alias("required"),
    ))
    one = F.concat(F.lit("{"), quote_json(signature["name"]), F.lit(":"), body, F.lit("}"))
    return F.when(signature.isNull(), F.lit("{}")).otherwise(one)


def error_words(chat: Column | str) -> Column:
    text = F.lower(col(chat))
    return F.array_compact(
        F.array(*[F.when(text.contains(w), F.lit(w)) for w in rules.CALL_ERROR_WORDS])
    )


def has_function_error(chat: Column | str) -> Column:
    return F.lower(col(chat)).rlike("(?s)" + rules.FUNCTION_ERROR_RESPONSE)


def has_conditional_error(chat: Column | str) -> Column:
    # a dot stops at newline only, as in the pattern's own dialect
    return F.lower(col(chat)).rlike("(?d)" + rules.CONDITIONAL_ERROR)


def user_turns(chat: Column | str) -> Column:
    return F.regexp_count(F.coalesce(col(chat), F.lit("")), F.lit("USER:"))


def first_user_text(chat: Column | str) -> Column:
    """Text of the first user turn, else the whole chat."""
    chat = col(chat)
    turn = strip(F.regexp_extract(chat, r"(?s)USER:(.*?)(?=ASSISTANT:|\z)", 1))
    return F.when(chat.contains("USER:"), turn).otherwise(chat)


def first_assistant_text(chat: Column | str) -> Column:
    """Text of the first assistant turn, '' if there is none."""
    return strip(
        F.regexp_extract(col(chat), r"(?s)ASSISTANT:(.*?)(?=USER:|<\|endoftext\|>|\z)", 1)
    )


def turn_bucket(turns: Column | str) -> Column:
    turns = col(turns)
    return first_match(
        [(turns <= 1, "single"), (turns <= 3, "short"), (turns <= 5, "medium")], F.lit("long")
    )


def call_bucket(calls: Column | str) -> Column:
    calls = col(calls)
    return first_match(
        [(calls <= 0, "no_calls"), (calls <= 1, "one_call"), (calls <= 2, "two_calls")],
        F.lit("many_calls"),
    )


def roles_missing(messages: Column | str) -> Column:
    """Which of system, user and assistant no message has."""
    roles = F.transform(col(messages), lambda m: m["role"])
    wanted = F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    return F.array_except(wanted, roles)
