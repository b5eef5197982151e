"""Explicit schemas: raw documents, parsed tables, landing rows.

Reading with these schemas replaces schema inference, which turns the
``(name, value)`` / ``(tag, flag)`` pairs of the landed JSON into
``array<array<string>>`` and needs implicit casts downstream.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# JSON keys of the raw source documents (the input format).
#   entity document: id, name, stats[].base_stat, stats[].stat.name,
#                    abilities[].is_hidden, abilities[].ability.name,
#                    types[].type.name
#   cohort document: id, name, pokemon_species[].name, abilities[].name
#   chain document:  id, chain.species.name, chain.evolves_to[] (each element
#                    has the same shape as chain, recursively)
# ---------------------------------------------------------------------------
COHORT_MEMBERS_KEY = "pokemon_species"

_NAMED = T.StructType([T.StructField("name", T.StringType())])

ENTITY_DOC = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField(
            "stats",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("base_stat", T.LongType()),
                        T.StructField("stat", _NAMED),
                    ]
                )
            ),
        ),
        T.StructField(
            "abilities",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("is_hidden", T.BooleanType()),
                        T.StructField("ability", _NAMED),
                    ]
                )
            ),
        ),
        T.StructField(
            "types",
            T.ArrayType(T.StructType([T.StructField("type", _NAMED)])),
        ),
    ]
)

COHORT_DOC = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField(COHORT_MEMBERS_KEY, T.ArrayType(_NAMED)),
        T.StructField("abilities", T.ArrayType(_NAMED)),
    ]
)

# Landed form written by the original job: pairs are JSON arrays, so an
# explicit read gives array<array<string>> and the values need casts (H8).
LEGACY_ENTITY_DOC = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("stats", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("abilities", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("types", T.ArrayType(T.StringType())),
    ]
)


# ---------------------------------------------------------------------------
# Parsed tables (our typed form)
# ---------------------------------------------------------------------------

MEASURE = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("value", T.LongType())]
)
TAG = T.StructType(
    [T.StructField("tag", T.StringType()), T.StructField("hidden", T.BooleanType())]
)

ENTITY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("measures", T.ArrayType(MEASURE)),
        T.StructField("tags", T.ArrayType(TAG)),
        T.StructField("kinds", T.ArrayType(T.StringType())),
    ]
)

COHORT = T.StructType(
    [
        T.StructField("cohort_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("members", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

CHAIN = T.StructType(
    [
        T.StructField("chain_id", T.LongType()),
        T.StructField("members", T.ArrayType(T.StringType())),
    ]
)

