"""Postal code, house number, city and state of an address, as column expressions over its normalised form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C
from .text import split_words

REGION_CODE = r"(?:^|,|\s)([A-Za-z]{2,3})\s+(\d{4,10})\s*$"
LOOSE_CODES = (r"\b(\d{2,3}\s?\d{3}\s?\d{3})\b", r"\b(\d{4,10})\b")


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _squeezed(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def _first(*values: Column) -> Column:
    """The first value that is not empty."""
    return F.coalesce(*(F.when(v != "", v) for v in values), F.lit(""))


def components(normalized: Column) -> Column:
    """struct(pincode, house_number, city, state); what cannot be told is empty."""
    segments = F.filter(F.transform(F.split(normalized, " , "), lambda s: F.trim(s)), lambda s: s != "")
    last = _text(F.try_element_at(segments, F.lit(-1)))
    tail = F.regexp_extract(last, r"(\d{3,10})\s*$", 1)
    shorn = F.when(tail != "", F.concat(F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(0))), F.array(F.trim(F.regexp_replace(last, r"\d{3,10}\s*$", ""))))).otherwise(segments)
    parts = F.filter(shorn, lambda s: s != "")
    loose = [F.when(F.size(parts) <= 1, _squeezed(_text(F.try_element_at(F.regexp_extract_all(normalized, F.lit(p), F.lit(1)), F.lit(-1))))).otherwise("") for p in LOOSE_CODES]
    pincode = _first(tail, F.regexp_extract(normalized, REGION_CODE, 2), *loose)
    return _places(parts, pincode)


def _places(parts: Column, pincode: Column) -> Column:
    # a one-element array carries the two inputs, so that each is computed once
    held = F.transform(F.array(F.struct(parts.alias("parts"), pincode.alias("pin"))), _located)
    return F.element_at(held, 1)


def _located(at: Column) -> Column:
    pin = at["pin"]
    content = F.filter(at["parts"], lambda s: (pin == "") | (_squeezed(s) != pin))
    n = F.size(content)
    one, two = _text(F.try_element_at(content, F.lit(-1))), _text(F.try_element_at(content, F.lit(-2)))
    region = (F.size(F.split(one, " ")) <= 3) & (F.length(one) <= 32) & ~one.rlike(r"\p{Nd}")
    state = F.when((n >= 3) & region, one).when(n == 1, F.regexp_extract(one, REGION_CODE, 1)).otherwise("")
    city = F.when((n >= 3) & region, two).when(n >= 3, one).when(n == 2, two).otherwise("")
    words = split_words(_text(F.try_element_at(content, F.lit(1))))
    numbered = lambda w: w.rlike(r"\p{Nd}") & (w != pin)
    after = F.transform(words, lambda w, i: F.when(w.isin(*C.NUMBER_MARKERS), F.try_element_at(F.filter(F.slice(words, i + 2, F.lit(2)), numbered), F.lit(1))))
    lead = _text(F.try_element_at(words, F.lit(1)))
    house = _first(_text(F.try_element_at(F.filter(after, lambda w: w.isNotNull()), F.lit(1))), F.when(numbered(lead) & (F.length(lead) <= 8), lead).otherwise(""))

    def clean(part: Column) -> Column:
        kept = F.array_join(F.filter(split_words(part), lambda w: ~w.isin(*C.ADDRESS_NOISE)), " ")
        return F.when(kept == pin, "").otherwise(kept)

    city, state, house = clean(city), clean(state), clean(house)
    city = F.when(city == state, "").otherwise(city)
    house = F.when((house == city) | (house == state), "").otherwise(house)
    return F.struct(pin.alias("pincode"), house.alias("house_number"), city.alias("city"), state.alias("state"))
