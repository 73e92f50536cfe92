"""City, neighborhood, property type and offer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.functions.bags import computed_once


def breadcrumb_place(breadcrumbs: Column) -> Column:
    """struct(city, neighborhood): the two steps that follow the anchor of the trail."""
    def after_anchor(trail: Column) -> Column:
        anchor = F.array_position(trail, V.BREADCRUMB_ANCHOR).cast("int")
        return F.when(anchor > 0, F.slice(trail, anchor + 1, F.lit(2)))

    def named(steps: Column) -> Column:
        area = F.trim(F.get(steps, F.lit(1)))
        kept = F.when(~area.isin(*V.NEIGHBORHOOD_PLACEHOLDERS), area)
        return F.struct(F.trim(F.get(steps, F.lit(0))).alias("city"), kept.alias("neighborhood"))

    trail = F.split(breadcrumbs, V.BREADCRUMB_SEPARATOR)
    return computed_once(computed_once(trail, after_anchor), named)


def paired_place(text: Column) -> Column:
    """struct(city, neighborhood) of 'neighborhood à city'; a lone name is both."""
    def named(parts: Column) -> Column:
        area = F.trim(F.get(parts, F.lit(0)))
        city = F.coalesce(F.trim(F.get(parts, F.lit(1))), area)
        return F.struct(city.alias("city"), area.alias("neighborhood"))

    return computed_once(F.split(text, V.PLACE_SEPARATOR), named)


def category_parts(category: Column) -> Column:
    """struct(property_type, phrase) of 'type, phrase'; no category is an empty type."""
    parts = F.split(F.coalesce(category, F.lit("")), r"\s*,\s*")
    return F.struct(
        F.trim(F.get(parts, F.lit(0))).alias("property_type"),
        F.trim(F.get(parts, F.lit(1))).alias("phrase"),
    )


def offer_of_mode(mode: Column) -> Column:
    """Reading modes that mean a sale; every other mode, also none, is a rental."""
    return F.when(mode.isin(*V.SALE_MODES), V.SALE).otherwise(V.RENT)


def offer_of_phrase(phrase: Column) -> Column:
    """The offer a category phrase speaks of, NULL if of none."""
    return (
        F.when(phrase.isin(*V.RENT_PHRASES), V.RENT)
        .when(phrase.isin(*V.SALE_PHRASES), V.SALE)
    )


def offer_matches(phrase: Column, offer: Column) -> Column:
    """True where phrase and offer agree; nothing to compare counts as a mismatch."""
    return F.coalesce(offer_of_phrase(phrase) == offer, F.lit(False))
