"""Whole records and their remarks: structure checks and blocks, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lengths of the public record format, and the types of remark blocks.
MANDATORY_LENGTH, LONGEST_RECORD, LONGEST_BLOCK = 105, 2844, 8192
REMARK_TYPES = ("SYN", "AWY", "MET", "SOD", "SOM", "HPD")


def structure_error(line: Column) -> Column:
    """The first fault of a fixed-width record; null where there is none, or no record."""
    text = F.regexp_replace(line, r"[\r\n]+$", "")
    size = F.length(text)
    variable = F.substring(text, 1, 4).try_cast("int")
    return (
        F.when(size > LONGEST_BLOCK, "block_length_exceeds_max")
        .when(size > LONGEST_RECORD, "record_length_exceeds_max")
        .when(size < MANDATORY_LENGTH, "mandatory_section_short")
        .when(size.isNotNull() & (variable.isNull() | (size != variable + MANDATORY_LENGTH)), "record_length_mismatch")
    )


def remark(text: Column) -> Column:
    """struct(types, texts) of a remark made of blocks (type, length, text) throughout; null for free text."""
    size = F.length(text)
    none = F.array().cast("array<string>")
    begin = F.struct(F.lit(1).alias("at"), none.alias("types"), none.alias("texts"), (size >= 6).alias("good"))

    def step(state: Column, _: Column) -> Column:
        at = state["at"]
        kind, digits = F.upper(text.substr(at, F.lit(3))), text.substr(at + 3, F.lit(3))
        length = F.when(digits.rlike("^[0-9]{3}$"), digits.try_cast("int"))
        body = text.substr(at + 6, length)
        fits = F.coalesce(kind.isin(*REMARK_TYPES) & (length >= 1) & (at + 5 + length <= size) & ~body.rlike(r"[^\x00-\x7f]"), F.lit(False))
        further = F.struct(
            F.when(fits, at + 6 + length).otherwise(at).alias("at"),
            F.when(fits, F.concat(state["types"], F.array(kind))).otherwise(state["types"]).alias("types"),
            F.when(fits, F.concat(state["texts"], F.array(body))).otherwise(state["texts"]).alias("texts"),
            fits.alias("good"),
        )
        return F.when(~state["good"] | (at > size), state).otherwise(further)

    # a block has seven characters at least
    end = F.aggregate(F.sequence(F.lit(1), F.greatest(F.floor(size / 7).cast("int"), F.lit(0)) + 1), begin, step)
    return F.when(end["good"] & (F.size(end["types"]) > 0) & (end["at"] > size), F.struct(end["types"].alias("types"), end["texts"].alias("texts")))


#: The elements of original-observation blocks, and what their tokens are made of.
OBSERVATION_ELEMENTS = "ABCDEFGHIJKLMNOPQRSTUVWXY"
_TOKEN = r"[!-+\x2D-~]"


def original_observation(text: Column) -> Column:
    """struct(elements, flags, data_values) of a QNN text; null where it isn't one throughout.

    n elements, each with four flag characters, come before n values of six; white space may stand between
    tokens. n follows from the length without white space, which is eleven characters an element.
    """
    trimmed = F.trim(text)
    payload = trimmed.substr(F.lit(4), F.length(trimmed))
    bare = F.regexp_replace(payload, r"\s", "")
    n = F.floor(F.length(bare) / 11).cast("int")
    count = n.cast("string")
    shape = F.concat(F.lit(rf"^(\s*[{OBSERVATION_ELEMENTS}]\s*{_TOKEN}{{4}}){{"), count, F.lit(rf"}}(\s*{_TOKEN}{{6}}){{"), count, F.lit(r"}\s*$"))
    whole = (F.upper(F.substring(trimmed, 1, 3)) == "QNN") & (n >= 1) & (F.length(bare) == n * 11)
    places = F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)
    cut = lambda first, step, width: F.transform(places, lambda i: bare.substr(first + i * step, F.lit(width)))
    made = F.struct(cut(F.lit(1), 5, 1).alias("elements"), cut(F.lit(2), 5, 4).alias("flags"), cut(n * 5 + 1, 6, 6).alias("data_values"))
    return F.when(whole, F.when(F.regexp_like(payload, shape), made))
