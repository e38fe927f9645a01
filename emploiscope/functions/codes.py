"""Codes, names and dates: masked numbers, "code label" text, Paris, snapshot months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three cities with arrondissements, and these.
PARIS = "75056"
PARIS_ARRONDISSEMENTS = [str(code) for code in range(75101, 75121)]
LYON = "69123"
LYON_ARRONDISSEMENTS = [str(code) for code in range(69381, 69390)]
MARSEILLE = "13055"
MARSEILLE_ARRONDISSEMENTS = [str(code) for code in range(13201, 13217)]

# Fixed value: text standing for a number withheld by statistical secrecy.
MASK = "*"

# Fixed value: collectivities without a parent département or region row.
ORPHAN_TERRITORIES = ["975", "977", "978", "984", "986", "987", "988", "989"]

# Accents folded before names are compared.
_ACCENTED, _PLAIN = "àâäçéèêëîïôöùûüÿ", "aaaceeeeiioouuuy"


def masked_number(text: Column) -> Column:
    """``*`` is NULL, not 0; any other text that is not an integer fails (ANSI)."""
    return F.nullif(text, F.lit(MASK)).cast("bigint")


def city_commune(code: Column) -> Column:
    """Arrondissements of Paris, Lyon and Marseille become their commune; other codes stay."""
    cities = {PARIS: PARIS_ARRONDISSEMENTS, LYON: LYON_ARRONDISSEMENTS, MARSEILLE: MARSEILLE_ARRONDISSEMENTS}
    folded = F.when(F.lit(False), code)
    for commune, arrondissements in cities.items():
        folded = folded.when(code.isin(arrondissements), commune)
    return folded.otherwise(code)


def departement_of_commune(code: Column) -> Column:
    """The département a commune code begins with: three characters overseas, two elsewhere."""
    return F.when(code.rlike("^9[78]"), F.substring(code, 1, 3)).otherwise(F.substring(code, 1, 2))


def leading_code(text: Column) -> Column:
    """Integer before the first space of "code label"."""
    return F.split(text, " ", 2)[0].cast("bigint")


def label_after_code(text: Column) -> Column:
    """Everything after the first space of "code label"; text without a space fails (ANSI)."""
    return F.split(text, " ", 2)[1]


def name_key(name: Column) -> Column:
    """Name folded for comparison: lower case, no accents, hyphens and apostrophes as spaces."""
    folded = F.translate(F.lower(name), _ACCENTED, _PLAIN)
    return F.trim(F.regexp_replace(folded, "[-'’ ]+", " "))


def utc_timestamp(text: Column) -> Column:
    """ISO-8601 text as an instant; text without an offset, or without a time, is taken as UTC.

    Offsets may be ``Z``, ``+02``, ``+0200`` or ``+02:00``.
    """
    offset = F.regexp_extract(text, "[T ].*?(Z|[+-][0-9]{2}(?::?[0-9]{2})?)$", 1)
    moment = F.when(offset == "", text).otherwise(F.left(text, F.length(text) - F.length(offset)))
    digits = F.regexp_replace(offset, ":", "")
    zone = F.when(digits.isin("", "Z"), "+00:00").otherwise(
        F.concat(F.substring(digits, 1, 3), F.lit(":"), F.coalesce(F.nullif(F.substring(digits, 4, 2), F.lit("")), F.lit("00")))
    )
    with_time = F.when(moment.rlike("[T ]"), moment).otherwise(F.concat(moment, F.lit("T00:00:00")))
    return F.concat(with_time, zone).cast("timestamp")


def month_tag(instant: Column) -> Column:
    """``YYYY-MM`` of an instant, in the session's zone (UTC)."""
    return F.date_format(instant, "yyyy-MM")


def rounded_percentage(part: Column, total: Column) -> Column:
    """``part`` as a percentage of ``total`` to one decimal; NULL unless both known and total > 0."""
    known = part.isNotNull() & total.isNotNull() & (total > 0)
    return F.when(known, F.round(part * F.lit(100.0) / total, 1))
