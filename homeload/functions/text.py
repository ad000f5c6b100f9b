"""Names, identifiers, prompts and model answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from homeload import schemas
from homeload.functions.arrays import let


def country_short_code(country: Column) -> Column:
    """First three letters without spaces, upper case: ``United States`` -> ``UNI``."""
    return F.upper(F.substring(F.replace(country, F.lit(" "), F.lit("")), 1, 3))


def initials(name: Column, words: int = 3) -> Column:
    """Upper-case first letters of the first ``words`` words."""
    parts = F.slice(F.split(F.trim(name), r"\s+"), 1, words)
    return F.array_join(F.transform(parts, lambda w: F.upper(F.substring(w, 1, 1))), "")


def household_id(country: Column, family_type: Column, number: Column) -> Column:
    return F.concat(
        country_short_code(country), F.lit("-"),
        initials(F.coalesce(family_type, F.lit("Unknown"))), F.lit("-"),
        zero_padded(number, 3),
    )


def zero_padded(number: Column, width: int) -> Column:
    """Pads to ``width`` digits; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def normalised_role(role: Column) -> Column:
    """Word-order-free role key: ``cultural_auditor`` equals ``auditor cultural``."""
    words = F.split(F.trim(F.lower(F.translate(role, "_", " "))), r"\s+")
    return F.array_join(F.array_sort(words), " ")


def display_role(role: Column) -> Column:
    return F.initcap(F.translate(role, "_", " "))


def day_label(name: Column, day_type: Column) -> Column:
    """``Monday (weekday)``; also used for ``household (weekday)``."""
    return F.concat(name, F.lit(" ("), day_type, F.lit(")"))


def work_regime(
    regime: Column, occupancy: Column, members: Column, regime_default: str = "{}"
) -> Column:
    """The three fields a consumption request carries about a household's routine."""
    return F.struct(
        F.coalesce(regime, F.lit(regime_default)).alias("household_work_regime"),
        F.coalesce(occupancy, F.lit("Unknown")).alias("weekday_daytime_occupancy_level"),
        members.alias("members"),
    )


def stage_of(name: Column) -> Column:
    """Stage folder a free-form stage name means; the first matching rule wins."""
    flat = F.replace(F.lower(name), F.lit(" "), F.lit(""))
    # Markers per stage, in order of precedence.
    return (
        F.when(_has_any(flat, ("1", "family", "families")), "stage1_family")
        .when(_has_any(flat, ("2", "weather")), "stage2_weather")
        .when(_has_any(flat, ("3", "consumption")), "stage3_consumption")
        .otherwise("unknown_stage")
    )


def _has_any(text: Column, markers: Sequence[str]) -> Column:
    hit = F.contains(text, F.lit(markers[0]))
    for marker in markers[1:]:
        hit = hit | F.contains(text, F.lit(marker))
    return hit


def extract_json(answer: Column) -> Column:
    """JSON text inside a free-form model answer.

    Reasoning blocks are dropped. A fenced object or array wins; else the text
    from the first opener to the last closer of the same kind; else the first
    brace followed by a quote up to the next closing brace; else the stripped
    text.
    """
    return let(F.regexp_replace(answer, r"(?s)<think>.*?</think>", ""), _json_in)


def _json_in(text: Column) -> Column:
    fenced = F.nullif(
        F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\}|\[.*?\])\s*```", 1), F.lit("")
    )
    at_bracket, at_brace = F.locate("[", text), F.locate("{", text)
    bracket_first = (at_bracket > 0) & ((at_brace == 0) | (at_bracket < at_brace))
    backwards = F.reverse(text)

    def between(start: Column, closer: str) -> Column:
        """From ``start`` to the last closer, null when that lies before it."""
        from_end = F.locate(closer, backwards)
        end = F.length(text) + 1 - from_end
        return F.when((start > 0) & (from_end > 0) & (end > start), F.substring(text, start, end - start + 1))

    spanned = F.when(bracket_first, between(at_bracket, "]")).otherwise(between(at_brace, "}"))
    loose = F.nullif(F.regexp_extract(text, r'(?s)(\{\s*".*?\})', 1), F.lit(""))
    return F.coalesce(fenced, spanned, loose, F.regexp_replace(text, r"^\s+|\s+$", ""))


def is_json(body: Column) -> Column:
    """Whether a text is exactly one JSON value; false for null.

    The text must be one element of an array and one value of an object: text
    behind the value breaks one of the two, whatever it is. Repeated keys and
    NaN are allowed, single quotes and raw control characters are not.
    """
    # Reader options for strict JSON without a length limit.
    strict = schemas.ANY_LENGTH | {"allowSingleQuotes": "false", "allowUnquotedControlChars": "false", "columnNameOfCorruptRecord": "_broken"}
    as_element = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>", strict)
    as_value = F.from_json(F.concat(F.lit('{"v":'), body, F.lit("}")), "_broken string", strict)
    return F.coalesce((F.array_size(as_element) == 1) & as_value["_broken"].isNull(), F.lit(False))


def render_template(template: Column, variables: Mapping[str, Column]) -> Column:
    """Fill ``$name`` and ``${name}``; names without a value stay in the text.

    All names are replaced in one left-to-right pass, so a value that itself
    holds ``$name`` is never expanded again, and ``$$`` becomes ``$``.
    """
    pieces = F.regexp_extract_all(
        template, F.lit(r"(?s)(\$\$|\$\{[_a-zA-Z][_a-zA-Z0-9]*\}|\$[_a-zA-Z][_a-zA-Z0-9]*|[^$]+|\$)"), 1
    )

    def fill(piece: Column) -> Column:
        out = F.when(piece == "$$", "$")
        for name, value in variables.items():
            out = out.when(
                piece.isin("$" + name, "${" + name + "}"), F.coalesce(value.cast("string"), F.lit(""))
            )
        return out.otherwise(piece)

    return F.array_join(F.transform(pieces, fill), "")


def unresolved_names(template: Column, known: Sequence[str]) -> Column:
    """Placeholders of a template that no variable fills, sorted and distinct."""
    names = F.regexp_extract_all(
        F.replace(template, F.lit("$$"), F.lit("")), F.lit(r"\$\{?([_a-zA-Z][_a-zA-Z0-9]*)"), 1
    )
    return F.array_sort(F.array_except(F.array_distinct(names), F.array(*[F.lit(k) for k in known])))


def with_suffix(prompt: Column, heading: str, body: Column) -> Column:
    """Append a headed section when its body is present."""
    present = body.isNotNull() & (body != "")
    return F.concat(prompt, F.when(present, F.concat(F.lit("\n\n" + heading + "\n"), body)).otherwise(""))


def context_block(context: Column) -> Column:
    """``- Title Key: value`` lines for the non-empty entries of a string map."""
    kept = F.map_filter(context, lambda k, v: v.isNotNull() & (v != ""))
    lines = F.transform(
        F.map_entries(kept),
        lambda e: F.concat(
            F.lit("- "), F.initcap(F.translate(e["key"], "_", " ")), F.lit(": "), e["value"]
        ),
    )
    return F.when(F.array_size(lines) > 0, F.array_join(lines, "\n")).otherwise("- No additional context")


def has_criteria(criteria: Column) -> Column:
    """False for an empty criteria text or one that is only a ``#`` note."""
    body = F.regexp_replace(F.coalesce(criteria, F.lit("")), r"^\s+", "")
    return (body != "") & ~F.startswith(body, F.lit("#"))
