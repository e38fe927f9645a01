"""Salary periodicity and annual amounts, from numbers or from a salary sentence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive bounds of the amounts taken as annual and as monthly pay.
ANNUAL_RANGE = (15000, 250000)
MONTHLY_RANGE = (1000, 14999)
MONTHS_PER_YEAR = 12

# Our choice for hourly pay: 35 hours a week, 52 weeks.
HOURS_PER_YEAR = 1820.0


def salary_source(low: Column, high: Column) -> Column:
    """``declare`` when either bound is present, else NULL."""
    return F.when(low.isNotNull() | high.isNotNull(), "declare")


def salary_period(low: Column, high: Column) -> Column:
    """``annuel``, ``mensuel`` or NULL, from the size of the first bound present."""
    amount = F.coalesce(low, high)
    return F.when(amount.between(*ANNUAL_RANGE), "annuel").when(amount.between(*MONTHLY_RANGE), "mensuel")


def annual_low(period: Column, low: Column) -> Column:
    return F.when(period == "annuel", low).when(period == "mensuel", low * MONTHS_PER_YEAR)


def annual_high(period: Column, low: Column, high: Column) -> Column:
    return annual_low(period, F.coalesce(high, low))


def midpoint(low: Column, high: Column) -> Column:
    """Middle of the annual bounds, or whichever bound is known."""
    return (F.coalesce(low, high) + F.coalesce(high, low)) / 2.0


# Reading of a salary sentence such as "Annuel de 35000.0 Euros à 45000.0 Euros sur 12.0 mois".
# Digit groups may be set apart by a space, a no-break space or a narrow no-break space; of two
# amounts the first may go without its currency. Anything else is unreadable and gives NULL.
GAP = "[ \u00a0\u202f]"
AMOUNT = f"([0-9]{{1,3}}(?:{GAP}[0-9]{{3}})+(?:[.,][0-9]+)?|[0-9]+(?:[.,][0-9]+)?)"
CURRENCY = f"{GAP}*(?:Euros?|€)"
RANGE = f"^[^0-9]*?{AMOUNT}(?:{CURRENCY})?{GAP}*à{GAP}*{AMOUNT}{CURRENCY}"
SINGLE = f"^[^0-9]*?{AMOUNT}{CURRENCY}"


def _number(text: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_replace(text, GAP, ""), ",", "."), F.lit("")).cast("double")


def sentence_period(sentence: Column) -> Column:
    """``annuel``, ``mensuel`` or ``horaire`` from the first word, else NULL."""
    word = F.lower(F.regexp_extract(sentence, r"^ *([A-Za-z]+)", 1))
    return F.when(word.isin("annuel", "mensuel", "horaire"), word)


def sentence_low(sentence: Column) -> Column:
    """The first amount of a range, or the only one."""
    return F.coalesce(_number(F.regexp_extract(sentence, RANGE, 1)), _number(F.regexp_extract(sentence, SINGLE, 1)))


def sentence_high(sentence: Column) -> Column:
    """The second amount; NULL when only one is given."""
    return _number(F.regexp_extract(sentence, RANGE, 2))


def sentence_months(sentence: Column) -> Column:
    """Months paid per year, 12 unless the sentence says otherwise."""
    return F.coalesce(_number(F.regexp_extract(sentence, "sur " + AMOUNT + " *mois", 1)), F.lit(float(MONTHS_PER_YEAR)))


def sentence_annual(period: Column, amount: Column, months: Column) -> Column:
    return (
        F.when(period == "annuel", amount)
        .when(period == "mensuel", amount * months)
        .when(period == "horaire", amount * HOURS_PER_YEAR)
    )
